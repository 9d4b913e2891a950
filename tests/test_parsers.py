"""Landed records: exact values, defaults, refused records."""

from __future__ import annotations

import itertools
import json
from datetime import UTC, date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline import schemas
from ledgerline.sources import (
    facebook_ads,
    google_ads,
    google_analytics,
    google_sheets,
    paypal,
    stripe,
)
from ledgerline.sources.landed import LANDED_DATE, PAGE, documents_from_text
from ledgerline.sources.records import PARSE_ERROR, accept, accepted, rejects

DAY = date(2024, 1, 15)
MORNING = 1705306500  # 2024-01-15 08:15:00 UTC


def documents(spark, schema, *bodies):
    texts = spark.createDataFrame(
        [(DAY, json.dumps(body)) for body in bodies],
        f"{LANDED_DATE} date, document string",
    )
    return documents_from_text(texts, schema)


def charge(**changes):
    body = {
        "id": "ch_77kq",
        "created": MORNING,
        "amount": 8640,
        "amount_captured": 8640,
        "balance_transaction": {"fee": 281, "net": 8359},
        "currency": "usd",
        "status": "succeeded",
        "description": "Harbour pilots, first instalment",
        "billing_details": {"email": "m.okafor@example.net", "name": "Mina Okafor"},
        "receipt_email": "billing@example.net",
        "payment_intent": "pi_77kq",
    }
    body.update(changes)
    return {key: value for key, value in body.items() if value != "absent"}


def parse_charges(spark, *charges, **page):
    pages = documents(
        spark, schemas.STRIPE_PAGE, {"data": list(charges), "has_more": False, **page}
    )
    return stripe.parse(stripe.unpack(pages))


def test_stripe_values(spark):
    row = accept(parse_charges(spark, charge()), "charge").drop(LANDED_DATE).head()
    assert row.asDict() == {
        "charge_id": "ch_77kq",
        "charge_date": DAY,
        "gross_amount_usd": Decimal("86.400000000"),
        "amount_captured_usd": Decimal("86.400000000"),
        "fee_usd": Decimal("2.810000000"),
        "net_usd": Decimal("83.590000000"),
        "currency": "usd",
        "status": "succeeded",
        "description": "Harbour pilots, first instalment",
        "customer_email": "m.okafor@example.net",
        "customer_name": "Mina Okafor",
        "payment_intent_id": "pi_77kq",
    }


@pytest.mark.parametrize("balance", [None, "txn_123", {}, "absent"])
def test_stripe_without_expanded_balance(spark, balance):
    row = accepted(parse_charges(spark, charge(balance_transaction=balance))).head()
    assert (row.fee_usd, row.net_usd) == (0, 0)


def test_stripe_optional_texts_default_to_empty(spark):
    bare = charge(
        description=None,
        billing_details={"email": None, "name": None},
        receipt_email="absent",
        payment_intent="absent",
    )
    row = accepted(parse_charges(spark, bare)).head()
    assert row.description == row.customer_email == row.customer_name == ""
    assert row.payment_intent_id == ""


def test_stripe_email_falls_back_over_empty_text(spark):
    body = charge(billing_details={"email": "", "name": "A"})
    assert accepted(parse_charges(spark, body)).head().customer_email == (
        "billing@example.net"
    )


@pytest.mark.parametrize(
    ("changes", "field"),
    [
        ({"id": "absent"}, "charge_id"),
        ({"created": "not-a-date"}, "charge_date"),
        ({"amount": None}, "gross_amount_usd"),
        ({"amount_captured": "1.5"}, "amount_captured_usd"),
        ({"currency": "absent"}, "currency"),
        ({"status": "absent"}, "status"),
        ({"billing_details": "absent"}, "customer_email"),
        ({"balance_transaction": {"fee": "x", "net": 1}}, "fee_usd"),
    ],
)
def test_stripe_refuses(spark, changes, field):
    refused = rejects(parse_charges(spark, charge(**changes))).collect()
    assert [row[PARSE_ERROR] for row in refused] == [field]


def test_accept_raises_with_the_record(spark):
    frame = accept(parse_charges(spark, charge(), charge(amount="many")), "charge")
    with pytest.raises(Exception, match="Failed to parse charge: gross_amount_usd.*many"):
        frame.collect()
    with pytest.raises(Exception, match="Failed to parse charge"):
        frame.count()


def test_stripe_pages_join_and_empty_pages_vanish(spark):
    pages = documents(
        spark,
        schemas.STRIPE_PAGE,
        {"data": [charge()], "has_more": True},
        {"data": [charge(id="ch_2")], "starting_after": "ch_77kq", "has_more": False},
        {"data": [], "has_more": False},
    )
    assert stripe.unpack(pages).count() == 2


def test_stripe_window_is_the_utc_day(spark):
    first = int(datetime(DAY.year, DAY.month, DAY.day, tzinfo=UTC).timestamp())
    seconds = [first - 1, first, first + 86399, first + 86400]
    rows = spark.createDataFrame([(str(s),) for s in [*seconds, "x"]], "created string")
    kept = rows.where(stripe.in_window(DAY, DAY)).collect()
    # An unreadable time is kept, for the parser to refuse.
    assert [row.created for row in kept] == [str(first), str(first + 86399), "x"]


def test_money_is_exact_beyond_a_billion(spark):
    row = accepted(parse_charges(spark, charge(amount=9_223_372_036_854_775_807))).head()
    assert row.gross_amount_usd == Decimal("92233720368547758.07")


def test_stripe_chain_report(spark):
    def page(first, last, more):
        body = {"data": [{"id": last}], "has_more": more}
        return {**body, "starting_after": first} if first else body

    def report(*pages):
        return stripe.page_report(documents(spark, schemas.STRIPE_PAGE, *pages)).head()

    one, two, three = page(None, "a", True), page("a", "b", True), page("b", "c", False)
    assert report(one, two, three).is_complete
    assert report(page(None, "a", False)).is_complete
    assert not report(one, three).is_complete
    assert not report(one, two).is_complete
    assert not report(two, three).is_complete
    assert not report(one, two, two, three).is_complete


def test_every_order_of_links_is_told_whole_or_not(spark):
    """Four pages with any cursors and ends against walking from the first page."""
    pages = {
        (n, cursors, lasts): [
            (n, f"p{i}", None if c is None else f"p{c}", i in lasts) for i, c in enumerate(cursors)
        ]
        for n, (cursors, lasts) in enumerate(
            itertools.product(
                itertools.product([None, 0, 1, 2, 3, 9], repeat=4), [(), (0,), (3,), (1, 2)]
            )
        )
    }

    def whole(cursors, lasts):
        starts = [i for i, c in enumerate(cursors) if c is None]
        at, seen = starts[0] if len(starts) == 1 else None, []
        while at is not None and at not in seen:
            seen.append(at)
            followers = [i for i, c in enumerate(cursors) if c == at]
            if at in lasts or len(followers) != 1:
                return len(seen) == 4 and at in lasts and not followers
            at = followers[0]
        return False

    rows = [row for chain in pages.values() for row in chain]
    links = spark.createDataFrame(rows, "chain int, end string, cursor string, is_last boolean")
    shaped = links.select("chain", F.struct("end", "cursor", "is_last").alias(PAGE))
    told = {r.chain: r.is_complete for r in stripe.link_report(shaped, ("chain",)).collect()}
    wrong = [key for key in pages if told[key[0]] != whole(key[1], key[2])]
    assert wrong == [] and 0 < sum(told.values()) < len(told)


def test_long_chains_and_loops(spark):
    """Chains of any length around powers of two, with and without a loop beside them."""
    rows, want = [], {}
    for n, (length, loop) in enumerate(itertools.product([1, 2, 3, 4, 5, 16, 17, 63, 80, 100], [0, 1, 2, 7, 90])):
        rows += [(n, f"a{i}", f"a{i - 1}" if i else None, i == length - 1) for i in range(length)]
        rows += [(n, f"b{i}", f"b{(i - 1) % loop}", False) for i in range(loop)]
        want[n] = (length + loop, loop, loop == 0)
    links = spark.createDataFrame(rows, "chain int, end string, cursor string, is_last boolean")
    shaped = links.select("chain", F.struct("end", "cursor", "is_last").alias(PAGE))
    report = stripe.link_report(shaped, ("chain",)).collect()
    assert {r.chain: (r.pages, r.looped_pages, r.is_complete) for r in report} == want


def transaction(**changes):
    info = {
        "transaction_id": "TX1",
        "paypal_reference_id": "REF1",
        "transaction_initiation_date": "2024-01-15T07:45:10+0000",
        "transaction_amount": {"value": "86.40", "currency_code": "USD"},
        "transaction_status": "S",
        "transaction_subject": "Enrollment",
        "fee_amount": {"value": "-2.81", "currency_code": "USD"},
        "transaction_net_amount": {"value": "83.59", "currency_code": "USD"},
    }
    payer = changes.pop(
        "payer",
        {
            "email_address": "a@example.com",
            "payer_name": {"given_name": "Mina", "surname": "Okafor"},
        },
    )
    info.update(changes)
    info = {key: value for key, value in info.items() if value != "absent"}
    body = {"transaction_info": info}
    return body if payer is None else {**body, "payer_info": payer}


def parse_transactions(spark, *bodies):
    page = {"page": 1, "total_pages": 1, "transaction_details": list(bodies)}
    return paypal.parse(paypal.unpack(documents(spark, schemas.PAYPAL_PAGE, page)))


def test_paypal_values(spark):
    row = accept(parse_transactions(spark, transaction()), "t").drop(LANDED_DATE).head()
    assert tuple(row) == (
        "REF1",
        DAY,
        Decimal("86.400000000"),
        "USD",
        "S",
        "Enrollment",
        "a@example.com",
        "Mina Okafor",
        Decimal("-2.810000000"),
        Decimal("83.590000000"),
    )


def test_paypal_defaults(spark):
    bare = transaction(
        payer=None,
        paypal_reference_id="",
        transaction_subject="absent",
        fee_amount="absent",
        transaction_net_amount="absent",
    )
    row = accepted(parse_transactions(spark, bare)).head()
    assert row.transaction_id == "TX1"
    assert row.transaction_subject == row.payer_email == row.payer_name == ""
    assert row.fee_amount_usd == row.net_amount_usd == 0


def test_paypal_name_skips_empty_parts(spark):
    only_surname = {"payer_name": {"given_name": "", "surname": "Okafor"}}
    assert accepted(
        parse_transactions(spark, transaction(payer=only_surname))
    ).head().payer_name == "Okafor"


def test_paypal_date_is_the_written_day(spark):
    late = transaction(transaction_initiation_date="2024-01-15T23:30:00-0500")
    assert accepted(parse_transactions(spark, late)).head().transaction_date == DAY


@pytest.mark.parametrize(
    ("changes", "field"),
    [
        ({"transaction_initiation_date": "not-a-date"}, "transaction_date"),
        ({"transaction_initiation_date": "absent"}, "transaction_date"),
        ({"transaction_amount": {"value": "x", "currency_code": "USD"}}, "gross_amount_usd"),
        ({"transaction_status": "absent"}, "transaction_status"),
        ({"fee_amount": {"value": "free"}}, "fee_amount_usd"),
        ({"paypal_reference_id": "", "transaction_id": "absent"}, "transaction_id"),
    ],
)
def test_paypal_refuses(spark, changes, field):
    refused = rejects(parse_transactions(spark, transaction(**changes))).collect()
    assert [row[PARSE_ERROR] for row in refused] == [field]


def test_paypal_missing_list_is_an_empty_page(spark):
    assert paypal.unpack(documents(spark, schemas.PAYPAL_PAGE, {"page": 1})).count() == 0


def test_paypal_window(spark):
    times = ["2024-01-14T23:59:59+0000", "2024-01-15T00:00:00+0000"]
    times += ["2024-01-15T23:59:59+0000", "2024-01-15T23:30:00-0500"]
    pages = documents(
        spark,
        schemas.PAYPAL_PAGE,
        {
            "transaction_details": [
                transaction(transaction_initiation_date=t) for t in times
            ]
        },
    )
    kept = paypal.unpack(pages).where(paypal.in_window(DAY, DAY))
    assert [
        r[0]
        for r in kept.select("transaction_info.transaction_initiation_date").collect()
    ] == times[1:3]


def test_paypal_page_report(spark):
    def report(*numbers):
        pages = [{"page": n, "total_pages": 3} for n in numbers]
        return paypal.page_report(documents(spark, schemas.PAYPAL_PAGE, *pages)).head()

    assert report(1, 2, 3).is_complete
    assert not report(1, 2, 3, 3).is_complete
    assert not report(1, 3).is_complete
    assert not report(1, 2, 4).is_complete


def ads_row(**metrics):
    values = {"clicks": "10", "impressions": "100", "costMicros": "864000"}
    values = {**values, "conversions": "2.0", **metrics}
    return {"segments": {"date": "2024-01-15"}, "metrics": values}


def parse_ads(spark, *bodies):
    rows = documents(spark, schemas.GOOGLE_ADS_ROW, *bodies)
    return google_ads.parse(google_ads.unpack(rows, F.lit("1234567890")))


def test_google_ads_values(spark):
    row = accept(parse_ads(spark, ads_row()), "ads").drop(LANDED_DATE).head()
    assert tuple(row) == (DAY, 10, 100, 864000, 2.0, "1234567890")


@pytest.mark.parametrize(
    ("metrics", "field"),
    [
        ({"clicks": "not-an-int"}, "clicks"),
        ({"clicks": "2.0"}, "clicks"),
        ({"conversions": None}, "conversions"),
        ({"conversions": "1.5d"}, "conversions"),
    ],
)
def test_google_ads_refuses(spark, metrics, field):
    refused = rejects(parse_ads(spark, ads_row(**metrics))).collect()
    assert [row[PARSE_ERROR] for row in refused] == [field]


def test_flatten_names_and_depth(spark):
    flat = google_ads.flatten_struct(
        spark.createDataFrame([], "segments struct<date:string>, n int")
    )
    assert flat.columns == ["segments.date", "n"]
    deep = spark.createDataFrame([], "metrics struct<nested:struct<inner:string>>")
    with pytest.raises(ValueError, match=r"Expected scalar value for metrics\.nested"):
        google_ads.flatten_struct(deep)


SMALL = google_analytics.ReportConfig(("date", "country"), ("sessions", "pageviews"))


def report_row(dimensions, metrics):
    return {
        "dimension_values": [{"value": v} for v in dimensions],
        "metric_values": [{"value": v} for v in metrics],
    }


def parse_report(spark, config, *rows):
    reports = documents(spark, schemas.ANALYTICS_REPORT, {"rows": list(rows)})
    return google_analytics.parse(google_analytics.unpack(reports, config), config)


def test_analytics_values(spark):
    rows = [
        report_row(("20240229", "Chile"), ("31", "64")),
        report_row(("20240301", ""), ("0", "9")),
    ]
    found = accept(parse_report(spark, SMALL, *rows), "report").drop(LANDED_DATE)
    assert found.columns == ["date", "country", "sessions", "pageviews"]
    assert [tuple(row) for row in found.collect()] == [
        (date(2024, 2, 29), "Chile", "31", "64"),
        (date(2024, 3, 1), "", "0", "9"),
    ]


def test_analytics_refuses_uneven_rows_and_missing_dates(spark):
    short = report_row(("20240101",), ("1", "2"))
    assert rejects(parse_report(spark, SMALL, short)).head()[PARSE_ERROR] == "row_length"
    undated = google_analytics.ReportConfig(("country",), ("sessions",))
    row = report_row(("Chile",), ("1",))
    assert rejects(parse_report(spark, undated, row)).head()[PARSE_ERROR] == "date"
    assert parse_report(spark, undated).count() == 0


PEOPLE = [
    ["name", "age", "city"],
    ["Ines", "61", "Porto"],
    ["Tariq", "", "Lahore"],
    ["Yun, Ha", "19", "Daegu\nBuk-gu"],
]


def parse_values(spark, values, columns=("name", "age", "city")):
    sheets = documents(spark, schemas.SHEET_VALUES, {"sheet": "people", "values": values})
    return google_sheets.parse(google_sheets.unpack(sheets), columns)


def test_sheet_values(spark):
    found = accept(parse_values(spark, PEOPLE), "people").drop(LANDED_DATE)
    assert [list(row) for row in found.collect()] == [[*row, None] for row in PEOPLE[1:]]


def test_sheet_header_only_and_empty(spark):
    assert parse_values(spark, PEOPLE[:1]).count() == 0
    with pytest.raises(Exception, match="Sheet 'people' is empty or has no header row"):
        parse_values(spark, []).count()


def test_sheet_refuses_uneven_rows_and_missing_columns(spark):
    uneven = rejects(parse_values(spark, [["name", "age", "city"], ["Ines", "61"]]))
    assert "row_length" in uneven.head()[PARSE_ERROR]
    other = rejects(parse_values(spark, PEOPLE, ("name", "height")))
    assert {row[PARSE_ERROR] for row in other.collect()} == {"height"}


def test_sheet_last_of_a_repeated_header_wins(spark):
    values = [["name", "name"], ["first", "last"]]
    assert accepted(parse_values(spark, values, ("name",))).head().name == "last"


def test_sheet_keeps_columns_nobody_asked_for(spark):
    values = [["age", "name", "x", "x"], ["61", "Ines", "1", "2"]]
    row = accepted(parse_values(spark, values, ("name",))).head()
    assert row.name == "Ines" and json.loads(row.other_columns) == {"age": "61", "x": "2"}


def insight(**changes):
    body = {
        "date_start": "2024-01-15",
        "campaign_id": "c1",
        "campaign_name": "Spring",
        "impressions": "7310",
        "clicks": "133",
        "spend": "18.07",
        "reach": "5802",
        "frequency": "1.26",
        "actions": [
            {"action_type": "link_click", "value": "212"},
            {"action_type": "lead", "value": "17"},
            {"action_type": "offsite_conversion.fb_pixel_purchase", "value": "4"},
        ],
    }
    body.update(changes)
    return {key: value for key, value in body.items() if value != "absent"}


def parse_insights(spark, *bodies):
    rows = documents(spark, schemas.FACEBOOK_INSIGHT, *bodies)
    return facebook_ads.parse(facebook_ads.unpack(rows))


def test_facebook_values(spark):
    row = accept(parse_insights(spark, insight()), "insight").drop(LANDED_DATE).head()
    assert tuple(row) == (
        DAY,
        "c1",
        "Spring",
        7310,
        133,
        Decimal("18.070000000"),
        5802,
        1.26,
        212,
        17,
        4,
    )


@pytest.mark.parametrize("actions", [[], "absent", None])
def test_facebook_without_actions(spark, actions):
    row = accepted(parse_insights(spark, insight(actions=actions))).head()
    assert (row.link_clicks, row.leads, row.conversions) == (0, 0, 0)


def test_facebook_last_duplicate_wins_and_truncates(spark):
    actions = [
        {"action_type": "lead", "value": "9"},
        {"action_type": "lead", "value": "4.7"},
        {"action_type": "link_click", "value": "-4.7"},
    ]
    row = accepted(parse_insights(spark, insight(actions=actions))).head()
    assert (row.leads, row.link_clicks) == (4, -4)


def test_facebook_refuses(spark):
    refused = rejects(parse_insights(spark, insight(reach="x"), insight(spend="absent")))
    assert sorted(row[PARSE_ERROR] for row in refused.collect()) == ["reach", "spend_usd"]
    assert rejects(parse_insights(spark, {})).count() == 1


def test_malformed_document_fails(spark):
    texts = spark.createDataFrame([(DAY, "{oops")], f"{LANDED_DATE} date, document string")
    with pytest.raises(Exception, match="(?i)malformed"):
        documents_from_text(texts, schemas.STRIPE_PAGE).collect()
