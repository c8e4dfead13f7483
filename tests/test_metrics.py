from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from namelens import schemas
from namelens.plans import approval, completion, enrichment, metrics, outbox

TS = dt.datetime(2026, 4, 10, 12)
BASELINE = (
    "client_id bigint, batch_id bigint, record_id string, ssa_lookup_match_flag int, ssa_reportable_gender string, "
    "ssa_confidence_level string, ssa_is_rare_name int, first_name_missing_flag int, "
    "ssa_max_probability decimal(10,6), ssa_probability_gap decimal(10,6), load_ts timestamp_ntz"
)


def golden(rows):
    """A hundred people with the counts of the published sample."""
    people = []
    genders = ["F"] * 48 + ["M"] * 50 + ["U"] * 2
    levels = ["MEDIUM", "LOW", "AMBIGUOUS"] + ["HIGH"] * 97
    for i, (g, level) in enumerate(zip(genders, levels)):
        people.append((1, 10, str(i), 1, g, level, 0, 0, Decimal("0.981638"), Decimal("0.963277"), TS))
    return rows(people, BASELINE)


def test_golden_payload(rows):
    """Names, order, labels and number format as in the published payload of the older metrics."""
    summary = metrics.batch_metrics(golden(rows), "v0.01", matched_only=False)
    text = metrics.metrics_payload(summary, "v0.01").first().enrichment_metrics_payload
    # Fixed value: the published payload.
    expected = {
        "analysis_type": "gender_metrics",
        "metrics": [
            {"metric_display_type": "INTEGER", "metric_label_sort": "VALUE", "metric_name": "Gender",
             "metric_sort": 1, "metric_type": "COUNT",
             "metrics": [{"label": "F", "value": 48}, {"label": "M", "value": 50}, {"label": "U", "value": 2}]},
            {"metric_display_type": "INTEGER", "metric_label_sort": "CONFIDENCE", "metric_name": "Confidence Level",
             "metric_sort": 2, "metric_type": "COUNT",
             "metrics": [{"label": "AMBIGUOUS", "value": 1}, {"label": "HIGH", "value": 97},
                         {"label": "LOW", "value": 1}, {"label": "MEDIUM", "value": 1}]},
            {"metric_display_type": "INTEGER", "metric_name": "Uncommon Names", "metric_sort": 3,
             "metric_type": "COUNT", "metrics": [{"label": "TOTAL_UNCOMMON_NAMES", "value": 0}]},
            {"metric_display_type": "INTEGER", "metric_name": "Missing First Name", "metric_sort": 4,
             "metric_type": "COUNT", "metrics": [{"label": "MISSING_FIRST_NAME", "value": 0}]},
            {"metric_display_type": "PERCENT", "metric_name": "Average Max Probability", "metric_sort": 5,
             "metric_type": "AVERAGE", "metrics": [{"label": "AVERAGE_MAX_PROBABILITY", "value": 0.981638}]},
            {"metric_display_type": "PERCENT", "metric_name": "Average Probability Gap", "metric_sort": 6,
             "metric_type": "AVERAGE", "metrics": [{"label": "AVERAGE_PROBABILITY_GAP", "value": 0.963277}]},
        ],
    }
    # The text itself: no blanks, keys in alphabetical order, whole numbers without a point.
    assert text == json.dumps(expected, separators=(",", ":"))


def test_unmatched_people(rows):
    people = rows(
        [(1, 10, "1", 1, "F", "HIGH", 1, 0, Decimal("0.95"), Decimal("0.9"), TS),
         (1, 10, "2", 0, None, None, None, 1, None, None, TS),
         (2, 20, "1", 0, None, None, None, 0, None, None, TS)],
        BASELINE,
    )

    def values(df):
        return {(r.batch_id, r.metric_name, r.metric_label): r.metric_value for r in df.collect()}

    now = values(metrics.batch_metrics(people, "v"))
    assert now == {
        (10, "Gender", "F"): 1, (10, "Confidence Level", "HIGH"): 1, (10, "Uncommon Names", "TOTAL_UNCOMMON_NAMES"): 1,
        (10, "Missing First Name", "MISSING_FIRST_NAME"): 1, (10, "Unmatched Records", "UNMATCHED"): 1,
        (10, "Average Max Probability", "AVERAGE_MAX_PROBABILITY"): Decimal("0.95"),
        (10, "Average Probability Gap", "AVERAGE_PROBABILITY_GAP"): Decimal("0.9"),
        (20, "Missing First Name", "MISSING_FIRST_NAME"): 0, (20, "Unmatched Records", "UNMATCHED"): 1,
    }
    older = values(metrics.batch_metrics(people, "v", matched_only=False))
    assert older[(10, "Gender", None)] == 1 and older[(20, "Confidence Level", None)] == 1
    assert older[(20, "Average Max Probability", "AVERAGE_MAX_PROBABILITY")] is None
    assert (10, "Unmatched Records", "UNMATCHED") not in older


def test_metrics_written_twice_stay_the_same(rows):
    people = rows([(1, 10, "2", 0, None, None, None, 1, None, None, TS)], BASELINE)
    found = metrics.batch_metrics(people, "v", matched_only=False)
    empty = found.limit(0)
    once = enrichment.upsert_metrics(empty, found)
    assert enrichment.upsert_metrics(once, found).count() == once.count() == 6
    # Null labels that do not match each other pile up.
    assert enrichment.upsert_metrics(once, found, null_safe=False).count() == 8


def test_delivery_message(rows):
    keys = rows([(1, 10), (1, 11)], "client_id bigint, batch_id bigint")
    batches = rows(
        [(10, 1, "b10", 100), (11, 1, "b11", None)],
        "id bigint, client_id bigint, app_batch_id string, processed_record_count bigint",
    )
    clients = rows([(1, "org")], "id bigint, app_organization_id string")
    statuses = rows(
        [(1, 10, "GNDRPR", "COMPLETED", '{"b":2,"a":1}'), (1, 10, "AGEXPD", "COMPLETED", '{"z":0}'),
         (1, 10, "AGCLPS", "COMPLETED", "{bad"), (1, 10, "OTHER", "RUNNING", "{}")],
        "client_id bigint, batch_id bigint, enrichment_type_code string, enrichment_status string, "
        "enrichment_metrics_payload string",
    )
    now = F.lit("2026-04-10 15:37:39.025").cast("timestamp_ntz")
    out = completion.delivery_payload(keys, batches, clients, statuses, now)
    texts = {r.batch_id: r.payload for r in out.collect()}
    assert texts[10] == (
        '{"batch_id":"b10","delivery_status":"READY","delivery_status_updated_at":"2026-04-10 15:37:39.025 +0000",'
        '"file_analysis":[{"z":0},{"a":1,"b":2}],"organization_id":"org","processed_record_count":100}'
    )
    assert json.loads(texts[11])["file_analysis"] == []
    assert "processed_record_count" not in json.loads(texts[11])


def test_outbox_after_delivery(rows):
    box = rows(
        [(1, "READY", None, None, "old", None), (2, "READY", 1, None, None, None), (3, "READY", 0, None, None, None),
         (4, "READY", 0, None, None, None)],
        "id bigint, status string, attempt_count int, last_attempt_ts timestamp_ntz, last_error string, "
        "processed_ts timestamp_ntz",
    )
    outcomes = rows(
        [(1, 204, "", None), (2, 404, "x" * 6000, None), (3, None, None, "e" * 6000)],
        "id bigint, http_status int, body string, error string",
    )
    now = F.lit(TS).cast("timestamp_ntz")
    out = {r.id: r for r in outbox.apply_delivery_outcomes(box, outcomes, now).collect()}
    assert (out[1].status, out[1].attempt_count, out[1].last_error, out[1].processed_ts) == ("SUCCEEDED", 1, None, TS)
    assert out[2].status == "FAILED" and out[2].attempt_count == 2 and out[2].processed_ts is None
    assert out[2].last_error == "HTTP 404: " + "x" * 5000
    assert out[3].last_error == "e" * 5000 and out[3].last_attempt_ts == TS
    assert (out[4].status, out[4].attempt_count) == ("READY", 0)
    assert tuple(outbox.delivery_totals(outcomes).first()) == (3, 1, 2)


def test_latest_decision(rows):
    day = [dt.datetime(2026, 1, d) for d in (1, 2, 3)]
    results = rows(
        [("o", "b1", "DENIED", None, day[2], 1), ("o", "b1", "APPROVED", day[1], day[0], 2),
         ("o", "b2", "DENIED", day[1], day[0], 3), ("o", "b2", "APPROVED", day[1], day[0], 4)],
        "app_organization_id string, app_batch_id string, status string, decision_ts timestamp_ntz, "
        "created_ts timestamp_ntz, seq bigint",
    )
    out = {r.app_batch_id: r.status for r in approval.latest_approval(results, "seq").collect()}
    assert out == {"b1": "DENIED", "b2": "APPROVED"}


def test_completion_needs_a_status_row(rows):
    keys = rows([(1, 10), (1, 11), (1, 12)], "client_id bigint, batch_id bigint")
    statuses = rows(
        [(1, 10, "COMPLETED"), (1, 11, "COMPLETED"), (1, 11, "FAILED")],
        "client_id bigint, batch_id bigint, enrichment_status string",
    )
    found = lambda **k: sorted(r.batch_id for r in enrichment.completion_candidates(keys, statuses, **k).collect())
    assert found() == [10]
    assert found(require_status=False) == [10, 12]


def test_status_changes(rows, spark):
    ddl = schemas.ENRICHMENT_STATUS
    early, now = dt.datetime(2026, 1, 1), F.lit(TS).cast("timestamp_ntz")

    def row(batch, code, status, started=None):
        return (1, batch, f"b{batch}", code, code, status, None, started, None, "old", early, early)

    statuses = rows(
        [row(1, "GNDRPR", "PENDING"), row(2, "GNDRPR", "PENDING", early), row(3, "NOPE", "PENDING"),
         row(4, "GNDRPR", "COMPLETED")], ddl)
    requests = enrichment.pending_requests(statuses)
    running = enrichment.advance_status(statuses, requests, now)
    codes = rows([("a", "GNDRPR", "Gender", 1)], schemas.ATTRIBUTE)
    out = {r.batch_id: r for r in enrichment.fail_unsupported(running, requests, codes, now).collect()}
    assert (out[1].enrichment_status, out[1].started_ts, out[1].error_message) == ("RUNNING", TS, None)
    assert out[2].started_ts == early
    assert (out[3].enrichment_status, out[3].error_message) == ("FAILED", "Unsupported enrichment type code.")
    assert (out[4].enrichment_status, out[4].error_message, out[4].updated_ts) == ("COMPLETED", "old", early)
