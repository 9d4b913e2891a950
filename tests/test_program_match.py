"""The LIKE join, both ways, against a brute-force matcher."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.program_match import (
    _file_by_piece,
    _in_map,
    _map_of_pieces,
    _patterns,
    _subject_pieces,
    match_programs,
)
from ledgerline.operators.sizing import SizeLimit, fits

PAYMENTS = "month int, transaction_subject string"
PROGRAMS = "program_id string, program_name string"


def like(text: str, name: str) -> bool:
    pattern = "".join(
        ".*" if c == "%" else "." if c == "_" else re.escape(c) for c in name.lower()
    )
    return re.fullmatch(f".*{pattern}.*", text.lower(), re.DOTALL) is not None


def brute_force(payments, programs):
    for month, subject in payments:
        found = [
            (pid, name)
            for pid, name in programs
            if subject is not None and name is not None and like(subject, name)
        ]
        for pid, name in found or [("unknown", "unknown")]:
            yield (month, subject, pid, name)


@pytest.mark.parametrize("limit", [SizeLimit(10_000, 1 << 20), SizeLimit(0, 0)])
def test_edges(spark, limit):
    payments = [
        (1, "Cosmetology Program"),
        (2, "BARBER course"),
        (3, None),
        (4, ""),
        (5, "axb gift"),
        (6, "nothing here"),
        (7, "a"),
        (8, "Barber and Cosmetology"),
        (9, "zz\\y and A\\b_c"),
    ]
    programs = [
        ("p1", "Cosmetology"),
        ("p2", "barber"),
        ("p2", "barber"),
        ("p3", "A_B"),
        ("p4", "here%nothing"),
        ("p5", "no%here"),
        ("p6", "a"),
        ("p7", None),
        ("p8", "zz\\y"),
        ("p9", "a\\b%"),
        ("p10", "q\\"),
    ]
    found = match_programs(
        spark.createDataFrame(payments, PAYMENTS),
        spark.createDataFrame(programs, PROGRAMS),
        limit,
    )
    assert Counter(map(tuple, found.collect())) == Counter(
        brute_force(payments, programs)
    )


@pytest.mark.parametrize("limit", [SizeLimit(10_000, 1 << 20), SizeLimit(0, 0)])
def test_empty_name_matches_every_subject(spark, limit):
    payments = [(1, "x"), (2, ""), (3, None)]
    programs = [("p1", ""), ("p2", "%"), ("p3", "_")]
    found = match_programs(
        spark.createDataFrame(payments, PAYMENTS),
        spark.createDataFrame(programs, PROGRAMS),
        limit,
    )
    assert Counter(map(tuple, found.collect())) == Counter(
        brute_force(payments, programs)
    )


def test_random_names_agree_with_brute_force(spark):
    pick = random.Random(7)

    def word(letters, low, high):
        return "".join(pick.choice(letters) for _ in range(pick.randint(low, high)))

    payments = [(n % 5, word("abcAB ", 0, 9)) for n in range(300)]
    programs = [(f"p{n}", word("abcB_%", 0, 5)) for n in range(60)]
    expected = Counter(brute_force(payments, programs))
    for limit in (SizeLimit(10_000, 1 << 20), SizeLimit(0, 0)):
        found = match_programs(
            spark.createDataFrame(payments, PAYMENTS),
            spark.createDataFrame(programs, PROGRAMS),
            limit,
        )
        assert Counter(map(tuple, found.collect())) == expected


def test_size_limit_counts_rows_and_text(spark):
    frame = spark.createDataFrame([("a", "bb"), ("c", None)], PROGRAMS)
    names = ["program_id", "program_name"]
    assert fits(frame, names, SizeLimit(2, 4))
    assert not fits(frame, names, SizeLimit(1, 4))
    assert not fits(frame, names, SizeLimit(2, 3))
    assert fits(frame.where("false"), names, SizeLimit(0, 0))


def test_the_map_holds_filed_pieces_and_few_others(spark):
    names = [(f"p{n}", f"name {n:04d} {chr(97 + n % 26)}") for n in range(2000)]
    filed = _file_by_piece(_patterns(spark.createDataFrame(names, PROGRAMS)))
    bits = _map_of_pieces(filed)
    assert filed.where(~_in_map(F.col("piece"), bits)).count() == 0
    others = spark.range(20_000).select(F.hex(F.xxhash64("id")).substr(1, 3).alias("piece"))
    known = filed.select("piece").distinct()
    met = others.join(known, "piece", "left_anti").where(_in_map(F.col("piece"), bits))
    assert met.count() < 200


def test_only_filed_lengths_are_cut_from_subjects(spark):
    text = spark.createDataFrame([("abcab",)], "t string")
    cut = lambda lengths: text.select(_subject_pieces(F.col("t"), lengths)).head()[0]
    assert cut([3]) == ["abc", "bca", "cab"]
    assert cut([0, 2]) == ["", "ab", "bc", "ca"] and cut([]) == []


def test_bare_names_beside_others(spark):
    payments = [(n, "é" * n) for n in range(6)] + [(9, "\\ab")]
    names = ["%", "__", "_%_", "\\", "\\_", "_____", "éé", "%é%", None, "______"]
    programs = [(f"p{n}", name) for n, name in enumerate(names)]
    expected = Counter(brute_force(payments, programs))
    for limit in (SizeLimit(10_000, 1 << 20), SizeLimit(0, 0)):
        found = match_programs(
            spark.createDataFrame(payments, PAYMENTS),
            spark.createDataFrame(programs, PROGRAMS),
            limit,
        )
        assert Counter(map(tuple, found.collect())) == expected
