"""Jobs that follow live weather, remember bookings in files, publish in one step and account for what they drop."""

import json

import pytest
from helpers import same
from test_jobs import world  # noqa: F401

from stayscope import fixtures, popular_stays
from stayscope.plans.jobs import (
    JobConfig,
    hotel_days,
    main,
    run_batch,
    start_adding,
    start_stage,
    start_stream,
    stream_result,
)
from stayscope.sources.tables import AtomicTable
from stayscope.streaming.accounts import Accounts
from stayscope.streaming.runner import AVAILABLE_NOW, run_out


def changed(world, root, **values):  # noqa: F811
    places = {"stream_output": f"{root}/out", "stream_checkpoint": f"{root}/cp", "batch_output": f"{root}/batch"}
    return JobConfig(**{**world[1].__dict__, **places, **values})


def expected(spark, sf_dir, config):
    return popular_stays(spark.read.parquet(config.stream_bookings), fixtures.weather(spark, sf_dir), config.grain)


@pytest.mark.parametrize("values", [{"live": True, "join_salts": 2}, {"memory": "files", "copies_within": "0 seconds"}, {}])
def test_streams_that_add_up(spark, sf_dir, world, tmp_path, values):  # noqa: F811
    config = changed(world, tmp_path, **values)
    days = None if config.live else hotel_days(spark, config)
    for _ in range(2):  # started again, it finds nothing new
        run_out((start_adding if values else start_stream)(spark, config, days, AVAILABLE_NOW))
        same(stream_result(spark, config), expected(spark, sf_dir, config))


def test_an_archived_stage_gives_the_same(spark, sf_dir, world, tmp_path):  # noqa: F811
    stage = {"stage": f"{tmp_path}/stage", "stage_checkpoint": f"{tmp_path}/cp1", "stage_archive": f"{tmp_path}/archive"}
    config = changed(world, tmp_path, **stage)
    days = hotel_days(spark, config)
    run_out(start_stage(spark, config, days, AVAILABLE_NOW))
    run_out(start_stream(spark, config, days, AVAILABLE_NOW))
    same(stream_result(spark, config), expected(spark, sf_dir, config))


def test_the_batch_publishes_in_one_step_in_the_measured_order(spark, sf_dir, world, tmp_path):  # noqa: F811
    config = changed(world, tmp_path, atomic_output=True, order="measured")
    accounts = Accounts()
    days = hotel_days(spark, config, accounts)
    for number in (1, 2):
        run_batch(spark, config, days, accounts)
        assert AtomicTable(config.batch_output).current(spark).number == number
    bookings, weather = spark.read.parquet(config.batch_bookings), fixtures.weather(spark, sf_dir)
    same(AtomicTable(config.batch_output).read(spark), popular_stays(bookings, weather))
    n = bookings.count()
    assert accounts.totals["batch_bookings"] == {"rows": 2 * n, "null_keys": 0}
    assert accounts.totals["weather"] == {"rows": weather.count(), "empty": 0, "malformed": 0}


def test_a_stream_accounts_for_its_bookings(spark, sf_dir, world, tmp_path):  # noqa: F811
    config = changed(world, tmp_path, accounts=True, join_salts=1)
    accounts = Accounts().listen(spark)
    try:
        run_out(start_stream(spark, config, hotel_days(spark, config, accounts), AVAILABLE_NOW))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        accounts.stop(spark)
    bookings = spark.read.parquet(config.stream_bookings)
    same(stream_result(spark, config), expected(spark, sf_dir, config))
    totals = accounts.totals
    assert totals["bookings"]["rows"] == bookings.count()
    assert totals["join"]["unmatched"] + totals["join"]["matched"] >= bookings.count()


def test_the_command_line_returns_the_accounts(spark, sf_dir, world, tmp_path, capsys):  # noqa: F811
    values = json.loads((world[0] / "job.json").read_text())
    values |= {"batch_output": str(tmp_path / "out"), "accounts": True}
    (tmp_path / "job.json").write_text(json.dumps(values))
    found = main([str(tmp_path / "job.json"), "--mode", "batch"])
    assert found["batch_bookings"]["rows"] == spark.read.parquet(values["batch_bookings"]).count()
    assert json.loads(capsys.readouterr().out)["weather"] == found["weather"]


@pytest.mark.parametrize("values", [{"memory": "tape"}, {"live": True, "memory": "files"}])
def test_modes_that_do_not_go_together(world, tmp_path, values):  # noqa: F811
    given = json.loads((world[0] / "job.json").read_text()) | values
    (tmp_path / "job.json").write_text(json.dumps(given))
    with pytest.raises(ValueError, match="memory"):
        main([str(tmp_path / "job.json"), "--mode", "stream"])


def test_a_live_stream_needs_a_schema(spark, world, tmp_path):  # noqa: F811
    topic = world[1].weather
    config = changed(world, tmp_path, live=True, weather=type(topic)(topic.fmt, topic.path, topic.options, "infer"))
    with pytest.raises(ValueError, match="schema"):
        start_adding(spark, config, None, AVAILABLE_NOW)
