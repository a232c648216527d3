"""Rows from literals, comparisons, and an independent computation in plain Python."""

from __future__ import annotations

import contextlib
import io
from collections import defaultdict
from datetime import date

from stayscope.streaming.runner import AVAILABLE_NOW, run_out, run_stream

BOOKING_DDL = (
    "id bigint, hotel_id bigint, srch_ci string, srch_co string, srch_children_cnt int"
)
WEATHER_DDL = "Id bigint, wthrDate string, avgTmprC double, Name string"


def bookings_of(spark, rows):
    return spark.createDataFrame(rows, BOOKING_DDL)


def weather_of(spark, rows):
    return spark.createDataFrame(rows, WEATHER_DDL)


def rows_of(frame, columns=None):
    """Rows as sorted tuples, in an order that nulls do not upset."""
    names = columns or sorted(frame.columns)
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=repr)


def same(left, right):
    assert sorted(left.columns) == sorted(right.columns)
    assert rows_of(left) == rows_of(right)


def finish(frame, sink, checkpoint, mode):
    run_out(run_stream(frame, sink, checkpoint, mode, AVAILABLE_NOW))


def plan_of(frame, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain(mode)
    return text.getvalue()


COUNTERS = [
    "erroneous_data_cnt",
    "short_stay_cnt",
    "standart_stay_cnt",
    "standart_extended_stay_cnt",
    "long_stay_cnt",
]


def expected_days(check_in, check_out):
    try:
        return abs((date.fromisoformat(check_out) - date.fromisoformat(check_in)).days)
    except (TypeError, ValueError):
        return None


def expected_counter(days):
    bounds = {1: (1, 1), 2: (2, 7), 3: (8, 14), 4: (15, 30)}
    for i, (low, high) in bounds.items():
        if days is not None and low <= days <= high:
            return COUNTERS[i]
    return COUNTERS[0]


def expected_enriched(bookings, weather):
    """(order, in, out, children, hotel, name) -> readings of that hotel-day and name."""
    found = defaultdict(list)
    for order, hotel, check_in, check_out, children in set(bookings):
        for reading_hotel, day, degrees, name in weather:
            if hotel is None or check_in is None or degrees is None or degrees <= 0:
                continue
            if (reading_hotel, day) == (hotel, check_in):
                found[order, check_in, check_out, children, hotel, name].append(degrees)
    return found


def expected_popular(bookings, weather, grain):
    groups = defaultdict(lambda: dict.fromkeys(COUNTERS, 0))
    for _, check_in, check_out, children, hotel, name in expected_enriched(bookings, weather):
        key = (name, hotel if grain == "hotel" else children)
        groups[key][expected_counter(expected_days(check_in, check_out))] += 1
    rows = []
    for (name, second), counts in groups.items():
        winner = max(COUNTERS, key=lambda c: (counts[c], c))
        total = sum(counts.values())
        with_children = total if second is not None and second > 0 else 0
        without = total if second is not None and second <= 0 else 0
        middle = (second,) if grain == "hotel" else (with_children, without)
        rows.append((name, *middle, *[counts[c] for c in COUNTERS], winner))
    return sorted(rows, key=repr)
