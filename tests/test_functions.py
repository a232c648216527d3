import pytest
from pyspark.sql import functions as F

from stayscope import STAY_CATEGORIES, StayCategory, argmax_name, category_label, stay_days
from stayscope.categories import fallback_of
from stayscope.functions.stay import category_description

COUNTERS = [c.counter for c in STAY_CATEGORIES]


@pytest.mark.parametrize(
    ("check_in", "check_out", "days"),
    [
        ("2017-08-24", "2017-08-28", 4),
        ("2017-08-28", "2017-08-23", 5),
        ("2017-08-24", "2017-08-24", 0),
        ("2016-02-28", "2016-03-01", 2),
        ("2017-08-24", None, None),
        (None, "2017-08-24", None),
        ("2017-08-24", "not a date", None),
        ("2017-13-01", "2017-08-24", None),
        ("", "2017-08-24", None),
    ],
)
def test_stay_days(spark, check_in, check_out, days):
    frame = spark.createDataFrame([(check_in, check_out)], "a string, b string")
    result = frame.select(stay_days(F.col("a"), F.col("b")).alias("d"))
    assert result.dtypes == [("d", "bigint")]
    assert result.first()["d"] == days


# Labels and descriptions of the stay categories at their bounds.
@pytest.mark.parametrize(
    ("days", "label", "description"),
    [
        (None, "Erroneous data", "null/ more than 30 days/ less or equal to 0"),
        (0, "Erroneous data", "null/ more than 30 days/ less or equal to 0"),
        (1, "Short stay", "1 day stay"),
        (2, "Standart stay", "2-7 days"),
        (7, "Standart stay", "2-7 days"),
        (8, "Standart extended stay", " 1-2 weeks"),
        (14, "Standart extended stay", " 1-2 weeks"),
        (15, "Long stay", "2-4 weeks (less than month)"),
        (30, "Long stay", "2-4 weeks (less than month)"),
        (31, "Erroneous data", "null/ more than 30 days/ less or equal to 0"),
    ],
)
def test_category_boundaries(spark, days, label, description):
    frame = spark.createDataFrame([(days,)], "d bigint")
    labelled = frame.select(category_label(F.col("d")).alias("label"))
    result = labelled.select("label", category_description(F.col("label")).alias("text")).first()
    assert (result["label"], result["text"]) == (label, description)


def test_own_categories(spark):
    own = [
        StayCategory("other", "anything else", "other_cnt"),
        StayCategory("week", "up to 7", "week_cnt", 0, 7),
    ]
    frame = spark.createDataFrame([(3,), (8,), (None,)], "d bigint")
    labels = [r[0] for r in frame.select(category_label(F.col("d"), own)).collect()]
    assert labels == ["week", "other", "other"]


def test_one_fallback_is_required():
    with pytest.raises(ValueError):
        fallback_of([StayCategory("a", "", "a_cnt", 1, 2)])
    with pytest.raises(ValueError):
        fallback_of([StayCategory("a", "", "a_cnt"), StayCategory("b", "", "b_cnt")])


def test_argmax_ties_go_to_the_name_that_sorts_last(spark):
    # Names of the counters, by the order in which ties go to them.
    order = [
        "standart_stay_cnt",
        "standart_extended_stay_cnt",
        "short_stay_cnt",
        "long_stay_cnt",
        "erroneous_data_cnt",
    ]
    for level in range(len(order)):
        tied = dict.fromkeys(COUNTERS, 0) | dict.fromkeys(order[level:], 3)
        frame = spark.createDataFrame([tuple(tied[c] for c in COUNTERS)], COUNTERS)
        assert frame.select(argmax_name(COUNTERS)).first()[0] == order[level]


def test_argmax_agrees_with_comparing_value_and_name(spark):
    values = [None, -1, 0, 2]
    rows = [(a, b, c) for a in values for b in values for c in values]
    frame = spark.createDataFrame(rows, "b bigint, c bigint, a bigint")
    pairs = [F.struct(F.col(n).alias("v"), F.lit(n).alias("n")) for n in ("b", "c", "a")]
    both = frame.select(
        argmax_name(["b", "c", "a"]).alias("ours"), F.greatest(*pairs)["n"].alias("pairs")
    )
    assert both.where(F.col("ours") != F.col("pairs")).count() == 0
    assert both.count() == len(rows)


def test_argmax_of_one_or_no_column(spark):
    assert spark.range(1).select(argmax_name(["id"])).first()[0] == "id"
    with pytest.raises(ValueError):
        argmax_name([])
