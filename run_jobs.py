"""For spark-submit: run_jobs.py job.json [--mode batch|stream|both]."""

from stayscope.plans.jobs import main

if __name__ == "__main__":
    main()
