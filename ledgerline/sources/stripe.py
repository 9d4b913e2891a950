"""Stripe charge pages: ``{starting_after, data: [charge, ...], has_more}``."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.calc import cents_to_dollars, epoch_bounds, epoch_to_date
from ledgerline.functions.casts import first_filled, refused, whole_number
from ledgerline.operators.chains import unreached
from ledgerline.session import ensure_checkpoint_dir
from ledgerline.sources.landed import LANDED_DATE, PAGE, kept_columns, unpacked
from ledgerline.sources.records import Field, parse_fields, unreadable_or


def unpack(pages: DataFrame) -> DataFrame:
    """One row per charge; an empty page gives none."""
    return unpacked(pages, F.col("data"))


def in_window(start: date | Column, end: date | Column) -> Column:
    """Charges created in the UTC days ``start`` to ``end``, both inclusive."""
    first, last = epoch_bounds(start, end)
    return unreadable_or(whole_number(F.col("created")).between(first, last))


def parse(charges: DataFrame) -> DataFrame:
    # An expanded balance transaction arrives as an object, an unexpanded one
    # as its id; only the object carries fee and net.
    balance = F.json_tuple("balance_transaction", "fee", "net")
    staged = charges.select("*", balance.alias("balance_fee", "balance_net"))
    col = F.col
    created = whole_number(col("created"))

    def required_text(name: str, source: str) -> Field:
        return Field(name, col(source), col(source).isNull())

    def required_cents(name: str, source: str) -> Field:
        cents = whole_number(col(source))
        return Field(name, cents_to_dollars(cents), refused(col(source), cents))

    def optional_cents(name: str, source: str) -> Field:
        cents = whole_number(F.coalesce(col(source), F.lit("0")))
        return Field(name, cents_to_dollars(cents), cents.isNull())

    fields = [
        required_text("charge_id", "id"),
        Field("charge_date", epoch_to_date(created), refused(col("created"), created)),
        required_cents("gross_amount_usd", "amount"),
        required_cents("amount_captured_usd", "amount_captured"),
        optional_cents("fee_usd", "balance_fee"),
        optional_cents("net_usd", "balance_net"),
        required_text("currency", "currency"),
        required_text("status", "status"),
        Field("description", first_filled(col("description"))),
        Field(
            "customer_email",
            first_filled(col("billing_details.email"), col("receipt_email")),
            col("billing_details").isNull(),
        ),
        Field("customer_name", first_filled(col("billing_details.name"))),
        Field("payment_intent_id", first_filled(col("payment_intent"))),
    ]
    return parse_fields(staged, fields, kept_columns(charges))


def page_link() -> Column:
    """What a page says of its place: its own last charge, the charge it continues from,
    and whether it is the last one."""
    return F.struct(
        F.try_element_at("data", F.lit(-1))["id"].alias("end"),
        F.nullif("starting_after", F.lit("")).alias("cursor"),
        F.coalesce(~F.col("has_more"), F.lit(True)).alias("is_last"),
    )


def page_report(
    pages: DataFrame, run_columns: tuple[str, ...] = (LANDED_DATE,)
) -> DataFrame:
    return link_report(pages.select(*run_columns, page_link().alias(PAGE)), run_columns)


def link_report(
    pages: DataFrame, run_columns: tuple[str, ...] = (LANDED_DATE,)
) -> DataFrame:
    """Per fetch (a run day, unless told otherwise): is its page chain whole?

    Pages form a chain: each one but the first names the last charge of the
    page before, and only the last has ``has_more = false``.  The set is whole
    when there is one first page, one last page, no cursor whose page was lost,
    no page landed twice, no page continued twice, none with more to come that is not
    continued, and none that the first page does not lead to.

    Every page gives two rows, one under its own last charge and one under the
    charge it continues from, so that one pass over the pages and one
    aggregate by charge pair them up.  Charge ids spread evenly.  What is left then is
    one chain, or one and loops beside it: a loop is what pointer doubling never
    brings back to a first page.
    """
    run_columns = list(run_columns)
    links = pages.where(F.col(PAGE).isNotNull()).select(*run_columns, f"{PAGE}.*")
    ends = links.select(
        *run_columns,
        F.inline(
            F.array(
                _count(F.col("end"), page=1, first=F.col("cursor").isNull(), last=F.col("is_last"), end=1, more=~F.col("is_last")),
                _count(F.col("cursor"), cursor=F.col("cursor").isNotNull()),
            )
        ),
    )
    by_charge = ends.groupBy(*run_columns, "charge").agg(
        *[F.sum(name).alias(name) for name in LINK_COUNTS]
    )
    named = F.col("charge").isNotNull()
    lost = F.when(F.col("end") == 0, F.col("cursor")).otherwise(0)
    repeated = F.when(named & (F.col("end") > 1), F.col("end") - 1).otherwise(0)
    forked = F.when(F.col("cursor") > 1, F.col("cursor") - 1).otherwise(0)
    # A page without charges has no end that another could continue from.
    is_open = F.when(~named | (F.col("cursor") == 0), F.col("more")).otherwise(0)
    report = by_charge.groupBy(*run_columns).agg(
        F.sum("page").alias("pages"),
        F.sum("first").alias("first_pages"),
        F.sum("last").alias("last_pages"),
        F.sum(lost).alias("broken_links"),
        F.sum(repeated).alias("repeated_pages"),
        F.sum(forked).alias("forked_links"),
        F.sum(is_open).alias("open_ends"),
    )
    ensure_checkpoint_dir(pages.sparkSession)
    report = report.checkpoint()
    straight = (
        (F.col("first_pages") == 1)
        & (F.col("last_pages") == 1)
        & (F.col("broken_links") + F.col("repeated_pages") == 0)
        & (F.col("forked_links") + F.col("open_ends") == 0)
    )
    looped = unreached(
        links.where(F.col("end").isNotNull())
        .join(report.where(straight & (F.col("pages") > 1)), run_columns, "left_semi")
        .select(*run_columns, F.col("end").alias("node"), F.col("cursor").alias("before")),
        run_columns,
    )
    loops = F.coalesce("unreached", F.lit(0).cast("bigint"))
    return (
        report.join(looped, run_columns, "left")
        .withColumn("looped_pages", loops)
        .withColumn("is_complete", straight & (loops == 0))
        .drop("unreached")
    )


LINK_COUNTS = ("page", "first", "last", "end", "more", "cursor")


def _count(charge: Column, **counts: Column | int) -> Column:
    given = {name: counts.get(name, 0) for name in LINK_COUNTS}
    return F.struct(
        charge.alias("charge"),
        *[
            (F.lit(n) if isinstance(n, int) else n).cast("bigint").alias(name)
            for name, n in given.items()
        ],
    )
