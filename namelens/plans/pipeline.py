"""The jobs from an uploaded file to a delivered result, over stored tables.

Every job takes the inserted rows that woke it and the name of the run. It may be
repeated after a failure: new rows are staged once per run, all writes are keyed,
and the repeat takes up again what the failure left running or failed. Keyed tables
are changed in the parts that a run touches.
"""

from __future__ import annotations

import contextvars
import functools
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from namelens import schemas
from namelens.operators import (
    add_absent,
    keyed_join,
    snapshot,
    temporary_snapshots,
    update_matching,
    upsert,
    with_new_ids,
)
from namelens.plans import (
    approval,
    completion,
    download,
    enrichment,
    ingest,
    lookups,
    metrics,
    outbox,
)
from namelens.plans.baseline import BATCH_KEYS, RECORD_KEYS
from namelens.plans.refresh import Chain
from namelens.sources.export import export_batch, export_lists
from namelens.sources.tables import KEYED, Tables, file_key

# Takes messages, sends them, returns their outcomes.
Sender = Callable[[DataFrame], DataFrame]

AGE_TABLES = {
    enrichment.AGE_EXPANDED_CODE: ("age_baseline_expanded", "age_results_expanded"),
    enrichment.AGE_COLLAPSED_CODE: ("age_baseline_collapsed", "age_results_collapsed"),
}
# The state of a queue's rows: what ``requeue`` sets back.
STATES = {
    "enrichment_status": "enrichment_status",
    "completion_queue": "processing_status",
    "download_ready_queue": "processing_status",
}


class EnrichmentError(RuntimeError):
    """Some enrichment types failed; the others are done. The run may be repeated."""


def one_at_a_time(job):
    """Jobs of one pipeline share tables, so only one of them runs at any time.

    Their intermediate snapshots are removed at the end.
    """

    @functools.wraps(job)
    def locked(self, *args, **kwargs):
        with self._lock, temporary_snapshots(self.tables.spark):
            return job(self, *args, **kwargs)

    return locked


class Pipeline:
    """The jobs over one set of tables."""

    def __init__(
        self,
        tables: Tables,
        model_version: str = enrichment.MODEL_VERSION,
        now: Callable[[], Column] = F.current_timestamp,
        all_open: bool = False,
        purge_landing: bool = True,
        purge_raw: bool = False,
        tries: int = 1,
    ):
        """``tries``: how often a run tries an enrichment type before its batches are FAILED."""
        self.tables = tables
        self.chain = Chain(tables)
        self.tries = tries
        self._lock = threading.RLock()
        self.model_version = model_version
        self._now = now
        self.all_open = all_open
        self.purge_landing = purge_landing
        self.purge_raw = purge_raw

    def now(self) -> Column:
        return self._now().cast("timestamp_ntz")

    @one_at_a_time
    def load_lookups(self, name_counts: DataFrame) -> None:
        """Store the birth counts and make the name lookups anew from them."""
        self.tables.replace("name_counts", name_counts)
        for name in ("gender_lookup", "age_lookup_generic", "age_lookup_specific"):
            self.chain.refresh(name)

    @one_at_a_time
    def process_files(self, landed: DataFrame, run: str) -> None:
        """Register the landed batches, store their people, ask for approval."""
        t = self.tables
        files = snapshot(ingest.landed_files(landed), "files")
        members = ingest.file_membership(files)
        file_keys = members.columns
        t.change("landed_file", members, lambda rows: add_absent(rows, members, file_keys, null_keys=False))
        clients, batches = t.read("client"), t.read("client_batch")
        top = batches.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
        new = ingest.register_batches(files, clients, batches)
        staged = t.stage(
            run,
            "client_batch",
            with_new_ids(new, [F.col("storage_file_name"), F.col("app_batch_id")], top).withColumn(
                "created_ts", self.now()
            ),
            schemas.BATCH,
        )
        t.change("client_batch", staged, lambda rows: add_absent(rows, staged, ["client_id", "id"], null_keys=False))
        batches = t.read("client_batch")

        keys = ingest.batch_keys(clients, batches)
        touched = snapshot(
            files.select(*ingest.APPROVAL_KEYS)
            .distinct()
            .join(keys, ingest.APPROVAL_KEYS)
            .select(*BATCH_KEYS),
            "touched",
        )
        stored = t.read_people("person_input", touched)
        fresh = ingest.raw_rows(landed, files, clients, batches, stored)
        t.replace_people("person_input", stored.unionByName(fresh))

        queue = t.read("approval_queue", files)
        entries = ingest.approval_entries(files, clients, batches)
        entries = entries.join(queue.select(*ingest.APPROVAL_KEYS), ingest.APPROVAL_KEYS, "left_anti")
        asked = t.stage(run, "approval_queue", entries, schemas.APPROVAL_QUEUE)
        new_entries = asked.select(*ingest.APPROVAL_KEYS, "batch_id", "status")
        queue = t.change("approval_queue", asked, lambda rows: ingest.enqueue_approval(rows, new_entries, self.now()))
        asked = queue.join(asked.select(*ingest.APPROVAL_KEYS), ingest.APPROVAL_KEYS, "left_semi")
        t.emit("approval_queue", asked, run)

    def request_approval(self, queued: DataFrame, run: str, send: Sender) -> DataFrame:
        """Send the pending requests to the credit service."""
        requests = approval.approval_requests(queued, self.tables.read("client_batch"))
        return send(approval.approval_message(requests))

    @one_at_a_time
    def approve(self, results: DataFrame, run: str) -> None:
        """Note the decisions, order the enrichments of approved batches, drop their landing rows."""
        t = self.tables
        decisions = snapshot(approval.latest_approval(results), "decisions")
        t.change("approval_queue", decisions, lambda rows: approval.apply_decisions(rows, decisions, self.now()))
        clients, batches = t.read("client"), t.read("client_batch")
        keys = approval.approved(decisions).join(ingest.batch_keys(clients, batches), ingest.APPROVAL_KEYS)
        statuses = t.read("enrichment_status", keys)
        wanted = approval.enrichment_requests(
            decisions, clients, batches, t.read("output_configuration"), statuses
        )
        staged = t.stage(
            run,
            "enrichment_status",
            wanted.withColumn("created_ts", self.now()).withColumn("updated_ts", self.now()),
            schemas.ENRICHMENT_STATUS,
        )
        t.change("enrichment_status", staged, lambda rows: add_absent(rows, staged, approval.STATUS_KEYS, null_keys=False))
        t.emit("enrichment_status", staged, run)
        if self.purge_landing:
            files = approval.approved_files(decisions, t.read("landed_file", decisions))
            # One short name for each file of the batches decided in this run.
            t.drop_landed({r[0] for r in files.select(file_key(F.col("storage_file_name"))).collect()})

    @one_at_a_time
    def start_enrichment(self, ordered: DataFrame, run: str) -> None:
        """Run the ordered enrichments and put finished batches in the completion queue.

        Types run side by side, each on its own: what one has done is kept when
        another fails. Then the run fails too, and its repeat does what is left.
        """
        t = self.tables
        requests = snapshot(enrichment.pending_requests(ordered), "requests")

        def started(rows: DataFrame) -> DataFrame:
            rows = enrichment.advance_status(rows, requests, self.now(), again=True)
            return enrichment.fail_unsupported(rows, requests, t.read("enrichment_attribute"), self.now())

        t.change("enrichment_status", requests, started)
        statuses = self._reject_repeated(requests)
        # At most one row per enrichment type.
        codes = {r[0] for r in requests.select("enrichment_type_code").distinct().collect()}
        jobs = {
            code: job
            for code, job in {
                enrichment.GENDER_CODE: self._enrich_gender,
                enrichment.AGE_EXPANDED_CODE: self._enrich_age,
                enrichment.AGE_COLLAPSED_CODE: self._enrich_age,
            }.items()
            if code in codes
        }
        payloads, errors = self._run_types(jobs, statuses)

        def ended(rows: DataFrame) -> DataFrame:
            for code, (payload, keys) in payloads.items():
                rows = enrichment.complete_status(rows, payload, keys, self.now(), code)
            for code, error in errors.items():
                mine = requests.where(F.col("enrichment_type_code") == code)
                rows = enrichment.fail_running(rows, mine, str(error), self.now())
            return rows

        worked = requests.select(*BATCH_KEYS)
        for _, keys in payloads.values():
            worked = worked.union(keys)
        worked = snapshot(worked.distinct(), "worked")
        statuses = t.change("enrichment_status", worked, ended)
        queue = t.read("completion_queue", worked)
        done = enrichment.completion_candidates(worked, statuses)
        done = done.join(queue.select(*BATCH_KEYS), BATCH_KEYS, "left_anti")
        staged = t.stage(f"{run}-{len(errors)}-failed" if errors else run, "completion_queue", done, schemas.COMPLETION_QUEUE)
        queue = t.change("completion_queue", staged, lambda rows: enrichment.enqueue_completion(rows, staged, self.now()))
        t.emit(
            "completion_queue",
            queue.join(staged.select(*BATCH_KEYS), BATCH_KEYS, "left_semi"),
            f"{run}-{len(errors)}-failed" if errors else run,
        )
        if errors:
            raise EnrichmentError("; ".join(f"{code}: {error}" for code, error in errors.items())) from next(iter(errors.values()))

    def _run_types(self, jobs: dict, statuses: DataFrame) -> tuple[dict, dict[str, Exception]]:
        """Run enrichment types side by side, each in a scheduler pool of its own name; they write different tables.

        Returns the payloads and batches of those that ended well, and the errors
        of the others.
        """
        sc = self.tables.spark.sparkContext

        def tried(code: str, job) -> tuple[DataFrame, DataFrame]:
            sc.setLocalProperty("spark.scheduler.pool", code)
            for left in reversed(range(max(self.tries, 1))):
                try:
                    keys = self._open_batches(statuses, code)
                    return job(code, keys), keys
                except Exception:
                    if not left:
                        raise
            raise AssertionError

        done, errors = {}, {}
        with ThreadPoolExecutor(max_workers=len(AGE_TABLES) + 1) as pool:
            running = {
                code: pool.submit(contextvars.copy_context().run, inheritable_thread_target(self.tables.spark)(tried), code, job)
                for code, job in jobs.items()
            }
            for code, future in running.items():
                try:
                    done[code] = future.result()
                except Exception as error:
                    errors[code] = error
        return done, errors

    def _open_batches(self, statuses: DataFrame, code: str) -> DataFrame:
        t = self.tables
        workable = enrichment.workable_batches(t.read("client_batch"), statuses, code, self.all_open)
        stored = t.people("person_input").pointer().select(*BATCH_KEYS)
        return snapshot(workable.join(stored, BATCH_KEYS, "left_semi"), "open-batches")

    def _reject_repeated(self, requests: DataFrame) -> DataFrame:
        """Fail the ordered batches that have a record id twice; the others go on."""
        t = self.tables
        people = t.read_people("person_input", requests.select(*BATCH_KEYS).distinct())
        bad = snapshot(enrichment.repeated_batches(people), "repeated-ids")
        mine = requests.join(bad, BATCH_KEYS, "left_semi")
        return t.change(
            "enrichment_status",
            requests,
            lambda rows: enrichment.fail_running(rows, mine, enrichment.REPEATED_ID, self.now()),
        )

    def _write_results(self, name: str, rows: DataFrame, keys: DataFrame) -> None:
        """Write result rows over the stored ones of their batches; other batches are not read."""
        stored = self.tables.read_people(name, keys)
        self.tables.replace_people(name, upsert(stored, rows, RECORD_KEYS, null_keys=False))

    def _enrich_gender(self, code: str, keys: DataFrame, model_version: str | None = None) -> DataFrame:
        t, version = self.tables, model_version or self.model_version
        self.chain.refresh("gender_baseline", keys)
        rows = t.read_people("gender_baseline", keys)
        self._write_results("gender_results", enrichment.to_results(rows, version), keys)
        store = t.read_people("improvement_store", keys)
        shared = enrichment.upsert_improvement(
            store, rows, t.read("client"), self.now(), version
        )
        t.replace_people("improvement_store", shared)
        counted = snapshot(metrics.batch_metrics(rows, version), "metrics")
        summary = t.change("gender_metrics", keys, lambda old: enrichment.upsert_metrics(old, counted))
        mine = summary.join(keys, BATCH_KEYS, "left_semi")
        return metrics.metrics_payload(mine, version)

    def _enrich_age(self, code: str, keys: DataFrame) -> DataFrame:
        """Age results. Their metrics are not defined, so the payload stays empty."""
        t = self.tables
        view, results = AGE_TABLES[code]
        self.chain.refresh(view, keys)
        rows = t.read_people(view, keys)
        self._write_results(results, enrichment.to_age_results(rows, self.model_version), keys)
        return keys.select(
            *BATCH_KEYS, F.lit(None).cast("string").alias("enrichment_metrics_payload")
        )

    @one_at_a_time
    def complete(self, queued: DataFrame, run: str) -> None:
        """Close the enriched batches and write their delivery messages."""
        t = self.tables
        # Counted once per run, before any people can be dropped.
        wanted = queued.select(*BATCH_KEYS).distinct()
        counted = t.stage(
            run,
            "completed_batches",
            completion.batch_counts(wanted, t.read_people("person_input", wanted)),
            schemas.COMPLETED_BATCH,
        )
        # Rows come again only if their run failed: what it left is taken up.
        queue = t.change(
            "completion_queue",
            counted,
            lambda rows: completion.start_completion(rows, counted, self.now(), again=True),
        )
        # A repeated run finds its batches completed and does nothing to them.
        running = queue.where(F.col("processing_status") == "RUNNING").select(*BATCH_KEYS)
        keys = snapshot(counted.join(running, BATCH_KEYS, "left_semi"), "to-complete")
        try:
            if not keys.isEmpty():
                self._complete(keys, run)
        except Exception as error:
            message = str(error)
            t.change(
                "completion_queue",
                counted,
                lambda rows: completion.fail_completion(rows, keys, message, self.now()),
            )
            raise
        queue = t.change(
            "completion_queue", counted, lambda rows: completion.finish_completion(rows, keys, self.now())
        )
        if self.purge_raw:
            batches = t.read("client_batch", counted.select("client_id", F.col("batch_id").alias("id")))
            self.chain.drop(snapshot(completion.delivered(counted, queue, batches), "delivered"))

    def _complete(self, keys: DataFrame, run: str) -> None:
        t = self.tables
        batches = t.change(
            "client_batch",
            keys.select("client_id", F.col("batch_id").alias("id")),
            lambda rows: completion.close_batches(rows, keys, self.now()),
        )
        messages = completion.delivery_payload(
            keys, batches, t.read("client"), t.read("enrichment_status", keys), self.now()
        )
        self._post(snapshot(messages, "messages"), run)

    def _post(self, messages: DataFrame, run: str) -> None:
        """Put messages into the outbox, number the new ones, and show them to the stream.

        A refreshed message is emitted too, so that it is sent again.
        """
        t = self.tables
        top = t.read("outbox").agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]

        def posted(rows: DataFrame) -> DataFrame:
            merged = snapshot(completion.outbox_upsert(rows, messages), "outbox")
            numbered = with_new_ids(
                merged.where(F.col("id").isNull()).drop("id"),
                [F.col("client_id"), F.col("batch_id"), F.col("event_type")],
                top,
            )
            return merged.where(F.col("id").isNotNull()).unionByName(numbered)

        box = t.change("outbox", messages, posted)
        mine = box.where(F.col("processed_ts").isNull()).join(
            messages.select(*completion.OUTBOX_KEYS).distinct(), completion.OUTBOX_KEYS, "left_semi"
        )
        t.emit("outbox", mine, run)

    @one_at_a_time
    def deliver(self, posted: DataFrame, run: str, send: Sender) -> dict[str, int]:
        """Send messages and note the outcomes; returns the totals."""
        outcomes = snapshot(send(posted.select("id", "payload")), "outcomes")
        self.tables.change(
            "outbox", posted, lambda rows: outbox.apply_delivery_outcomes(rows, outcomes, self.now())
        )
        return outbox.delivery_totals(outcomes).first().asDict()

    @one_at_a_time
    def prepare_download(
        self, organization: str, batch: str, out: str, single_file: bool = False
    ) -> str:
        """Export one batch in its configured columns; returns its object key.

        The key is a folder of files, or one file if that is asked for.
        """
        t = self.tables
        found = download.resolve_batch(t.read("client"), t.read("client_batch"), organization, batch)
        if found is None:
            raise LookupError(f"no batch {batch} of organization {organization}")
        mine = t.spark.createDataFrame([tuple(found)[:2]], "client_id bigint, batch_id bigint")
        rows = download.download_rows(
            t.read_people("person_input", mine), t.read_people("gender_results", mine)
        )
        columns = download.ordered_columns(t.read("output_configuration"), organization, batch)
        key = f"downloads/{organization}/{batch}/results_{batch}" + (".csv.gz" if single_file else "")
        export_batch(rows, f"{out.rstrip('/')}/{key}", columns, single_file)
        entry = t.spark.createDataFrame(
            [(organization, batch)], "app_organization_id string, app_batch_id string"
        )
        run = f"download-{organization}-{batch}-{uuid.uuid4().hex}"
        self._announce(download.ready_entries(entry, F.lit(key)), run)
        return key

    @one_at_a_time
    def prepare_downloads(self, queued: DataFrame, run: str, out: str) -> None:
        """Export every pending batch, each in its own columns, all in one job."""
        t = self.tables
        clients, batches = t.read("client"), t.read("client_batch")
        keys = download.export_lists(
            download.pending_keys(queued, clients, batches), t.read("output_configuration")
        )
        keys = snapshot(keys, "downloads")
        if keys.isEmpty():
            return
        people = keyed_join(t.read_people("person_input", keys), keys, BATCH_KEYS, "inner", stored=True)
        rows = download.download_rows(people, t.read_people("gender_results", keys))
        folder = f"downloads/{run}"
        export_lists(rows, f"{out.rstrip('/')}/{folder}")
        place = download.folder_key(folder, F.col("app_organization_id"), F.col("app_batch_id"))
        self._announce(download.ready_entries(keys.drop("columns"), place), run)

    def _announce(self, entries: DataFrame, run: str) -> None:
        """Note where results lie and queue the announcements; a repeated one is sent again."""
        t = self.tables
        clients = t.read("client")
        keys = ingest.batch_keys(clients, t.read("client_batch"))
        keys = entries.join(keys, ingest.APPROVAL_KEYS).select("client_id", F.col("batch_id").alias("id"))
        t.change("client_batch", keys, lambda rows: download.set_object_keys(rows, clients, entries))
        queue = t.change(
            "download_ready_queue",
            entries,
            lambda rows: download.download_ready_upsert(rows, entries, self.now()),
        )
        t.emit(
            "download_ready_queue",
            queue.join(entries.select(*ingest.APPROVAL_KEYS), ingest.APPROVAL_KEYS, "left_semi"),
            run,
        )

    @one_at_a_time
    def announce_downloads(self, ready: DataFrame, run: str, send: Sender) -> dict[str, int]:
        """Send the announcements and note the outcomes; returns the totals."""
        messages = outbox.download_messages(enrichment.pending(ready))
        outcomes = snapshot(send(messages), "outcomes")
        self.tables.change(
            "download_ready_queue",
            ready,
            lambda rows: outbox.apply_download_outcomes(rows, outcomes, self.now()),
        )
        return outbox.delivery_totals(outcomes).first().asDict()

    @one_at_a_time
    def requeue(self, name: str, keys: DataFrame, run: str) -> None:
        """Set failed rows of a queue back to PENDING and show them to their stream once more.

        ``keys`` has the key columns of the rows, all or some of them (without a
        type code all types of a batch). Rows in another state stay as they are.
        The name of the run must be new.
        """
        t, state = self.tables, STATES[name]
        on = [c for c in keys.columns if c in schemas.struct(KEYED[name]).fieldNames()]
        keys = snapshot(keys.select(*on).distinct(), "requeued")
        failed = t.read(name, keys).where(F.col(state) == "FAILED").join(keys, on, "left_semi")
        staged = t.stage(run, name, failed.withColumn(state, F.lit("PENDING")), KEYED[name])

        def reset(rows: DataFrame) -> DataFrame:
            sets = {state: F.lit("PENDING"), "error_message": F.lit(None), "updated_ts": self.now()}
            return update_matching(rows, keys, on, sets, guard=F.col(state) == "FAILED")

        t.change(name, keys, reset)
        t.emit(name, staged, run)

    @one_at_a_time
    def release_batch(self, client_id: int, batch_id: int, model_version: str | None = None) -> None:
        """Store the results of one batch by hand, under a model version of its own, and drop its raw people."""
        t = self.tables
        keys = t.spark.createDataFrame([(client_id, batch_id)], "client_id bigint, batch_id bigint")
        self._enrich_gender(enrichment.GENDER_CODE, keys, model_version)
        self.chain.drop(keys)
