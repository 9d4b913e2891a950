"""Match payment subjects with programs by name.

A subject matches a program when ``lower(subject) LIKE '%lower(name)%'``.  The
name is a pattern: ``%`` and ``_`` in it are wildcards, a backslash is itself.  A
subject may match several programs and is repeated for each; one that matches none
gets the program ``unknown``.

Every name is filed under one short piece of its literal text.  A subject that contains
a name contains that name's piece, so only programs filed under a piece of the subject
are compared with it.  Up to a measured number of programs the filing is a constant of
the plan and subjects are matched within their own rows; beyond it the pieces are an
equi join, of only those pieces of a subject that a bitmap of the filed ones has.  Names
without any literal text, which every long enough subject matches, are joined by length.
All ways give the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.sizing import IN_PLAN_LIMIT, SizeLimit, fits
from ledgerline.session import ensure_checkpoint_dir

UNKNOWN = "unknown"
PIECE_LENGTH = 3
# Bits of the map of filed pieces, 128 KB: some 50,000 three-letter pieces fill a twentieth.
MAP_BITS = 1 << 20
# A piece that many subjects share is spread over this many join keys.
SALTS = 16
WILDCARDS = r"[%_\\]"
# No text holds it, so a pattern has no escapes.
NO_ESCAPE = "\x00"


def match_programs(
    payments: DataFrame,
    programs: DataFrame,
    limit: SizeLimit = IN_PLAN_LIMIT,
) -> DataFrame:
    """``payments`` with ``program_id`` and ``program_name`` added."""
    # The condition yields null for a null name, so such programs cannot match.
    # Written once: it is measured, filed and joined.
    ensure_checkpoint_dir(programs.sparkSession)
    named = (
        programs.select("program_id", "program_name")
        .where(F.col("program_name").isNotNull())
        .checkpoint()
    )
    if fits(named, ["program_id", "program_name"], limit):
        joined = _match_in_row(payments, named)
    else:
        joined = _match_by_piece(payments, named)
    return joined.select(
        *payments.columns,
        F.coalesce("program_id", F.lit(UNKNOWN)).alias("program_id"),
        F.coalesce("program_name", F.lit(UNKNOWN)).alias("program_name"),
    )


def _patterns(programs: DataFrame) -> DataFrame:
    lowered = F.lower("program_name")
    return programs.select(
        "*",
        lowered.alias("needle"),
        lowered.rlike(WILDCARDS).alias("has_wildcard"),
    )


def _contains(needle: Column, has_wildcard: Column) -> Column:
    """The LIKE condition; plain names skip the pattern matcher."""
    subject = F.col("subject_text")
    pattern = F.concat(F.lit("%"), needle, F.lit("%"))
    return F.when(has_wildcard, F.like(subject, pattern, F.lit(NO_ESCAPE))).otherwise(
        F.contains(subject, needle)
    )


def _match_in_row(payments: DataFrame, programs: DataFrame) -> DataFrame:
    """Matches as arrays of each payment: no join, no row but the hits."""
    filed: dict[str, list[dict]] = {}
    # As many rows as the limit allows.
    for row in _file_by_piece(_patterns(programs)).collect():
        values = row.asDict()
        filed.setdefault(values.pop("piece"), []).append(values)
    kind = (
        "map<string,array<struct<program_id:string,program_name:string,"
        "needle:string,has_wildcard:boolean>>>"
    )
    by_piece = F.from_json(F.lit(json.dumps(filed)), kind)
    pieces = F.from_json(F.lit(json.dumps(sorted(filed))), "array<string>")
    lengths = sorted({len(piece) for piece in filed})
    hits = F.array_intersect(_subject_pieces(F.col("subject_text"), lengths), pieces)
    near = F.flatten(F.transform(hits, lambda piece: F.element_at(by_piece, piece)))
    found = F.filter(near, lambda p: _contains(p["needle"], p["has_wildcard"]))
    hit = F.col("hit")
    return (
        payments.withColumn("subject_text", F.lower("transaction_subject"))
        .withColumn("hit", F.explode_outer(found))
        .select(
            *payments.columns,
            hit["program_id"].alias("program_id"),
            hit["program_name"].alias("program_name"),
        )
    )


def _match_by_piece(payments: DataFrame, programs: DataFrame) -> DataFrame:
    # Read three times below, so the aggregated payments are written once to the
    # checkpoint folder instead of computed again.
    ensure_checkpoint_dir(payments.sparkSession)
    payments = payments.checkpoint()
    subjects = (
        payments.where(F.col("transaction_subject").isNotNull())
        .select("transaction_subject")
        .distinct()
        .withColumn("subject_text", F.lower("transaction_subject"))
    )
    # One row per distinct name and program; read for the map, the lengths and the join.
    filed = _file_by_piece(_patterns(programs)).checkpoint()
    literal, bare = filed.where("piece <> ''"), filed.where("piece = ''")
    filed_pieces = _map_of_pieces(literal)
    near = F.filter(
        _subject_pieces(F.col("subject_text"), range(1, PIECE_LENGTH + 1)),
        lambda piece: _in_map(piece, filed_pieces),
    )
    looked_up = subjects.select(
        "*",
        F.pmod(F.xxhash64("subject_text"), F.lit(SALTS)).alias("salt"),
        F.explode(near).alias("piece"),
    )
    spread = literal.withColumn(
        "salt", F.explode(F.array([F.lit(n).cast("bigint") for n in range(SALTS)]))
    )
    pairs = looked_up.join(spread, ["piece", "salt"])
    # As many rows as the longest name has letters.
    least = F.char_length(F.replace("needle", F.lit("%")))
    sizes = sorted(r[0] for r in bare.select(least).distinct().collect())
    if sizes:
        fitting = F.filter(
            F.from_json(F.lit(json.dumps(sizes)), "array<int>"),
            lambda size: size <= F.char_length("subject_text"),
        )
        by_size = subjects.select("*", F.explode(fitting).alias("size")).join(
            bare.withColumn("size", least), "size"
        )
        columns = ["transaction_subject", "subject_text", *filed.columns]
        pairs = pairs.select(*columns).unionByName(by_size.select(*columns))
    pairs = pairs.where(_contains(F.col("needle"), F.col("has_wildcard"))).select(
        "transaction_subject", "program_id", "program_name"
    )
    return payments.join(pairs, "transaction_subject", "left")


def _bit(piece: Column) -> Column:
    return F.pmod(F.xxhash64(piece), F.lit(MAP_BITS))


def _map_of_pieces(filed: DataFrame) -> Column:
    """Bits of the filed pieces, as an array of whole numbers that is part of the plan.

    Built where the pieces are; ``MAP_BITS / 64`` numbers come to the driver.
    """
    bit = filed.select(_bit(F.col("piece")).alias("bit")).distinct()
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int"))
    numbers = bit.groupBy(F.floor(F.col("bit") / 64).alias("at")).agg(F.bit_or(one).alias("n"))
    found = [0] * (MAP_BITS // 64)
    for row in numbers.collect():
        found[row["at"]] = row["n"]
    return F.from_json(F.lit(json.dumps(found)), "array<bigint>")


def _in_map(piece: Column, filed_pieces: Column) -> Column:
    """Whether a piece's bit is set: always for a filed one, seldom for another."""
    bit = _bit(piece)
    number = F.get(filed_pieces, F.floor(bit / 64).cast("int"))
    return F.getbit(number, (bit % 64).cast("int")) == 1


def _pieces(text: Column, length: int) -> Column:
    """All substrings of one length; none where the text is shorter."""
    starts = F.sequence(F.lit(1), F.char_length(text) - (length - 1))
    return F.when(
        F.char_length(text) >= length,
        F.transform(starts, lambda start: F.substring(text, start, F.lit(length))),
    ).otherwise(F.array().cast("array<string>"))


def _subject_pieces(text: Column, lengths: Iterable[int]) -> Column:
    """Pieces of the given lengths."""
    by_length = [_pieces(text, n) if n else F.array(F.lit("")) for n in lengths]
    return F.array_distinct(F.concat(*by_length)) if by_length else F.array().cast("array<string>")


def _file_by_piece(programs: DataFrame) -> DataFrame:
    """Each program with the piece of its name that fewest names share.

    Pieces come from the longest literal run between wildcards; runs shorter
    than ``PIECE_LENGTH`` are their own piece, down to the empty one.
    """
    runs = F.split("needle", WILDCARDS)
    longest = F.element_at(
        F.array_sort(
            F.transform(
                runs, lambda r: F.struct(F.char_length(r).alias("size"), r.alias("run"))
            )
        ),
        -1,
    )["run"]
    names = (
        programs.select("needle")
        .distinct()
        .select("needle", longest.alias("run"))
        .select(
            "needle",
            F.explode(
                F.when(
                    F.char_length("run") <= PIECE_LENGTH, F.array("run")
                ).otherwise(F.array_distinct(_pieces(F.col("run"), PIECE_LENGTH)))
            ).alias("piece"),
        )
    )
    shared = names.groupBy("piece").agg(F.count(F.lit(1)).alias("names"))
    rarest = (
        names.join(shared, "piece")
        .groupBy("needle")
        .agg(F.min_by("piece", F.struct("names", "piece")).alias("piece"))
    )
    return programs.join(rarest, "needle")
