"""Jobs over stored tables as queries: what stands there after failures, repeats and changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from namelens import schemas
from namelens.operators import keyed_join, scratch_path, snapshot
from namelens.plans import approval, baseline, enrichment, ingest, metrics
from namelens.plans.baseline import BATCH_KEYS
from namelens.plans.pipeline import EnrichmentError, Pipeline
from namelens.plans.refresh import Chain
from namelens.registry import VERSION, Inputs, _as, _download, query, run_ts
from namelens.sources.export import export_lists
from namelens.sources.files import fill_record_ids, list_files, load_voter_file, read_batch_file, read_name_counts
from namelens.sources.parts import WRITE
from namelens.sources.tables import Tables

TYPES = {"GNDRPR": "Gender", "AGEXPD": "Age, seven groups", "AGCLPS": "Age, four groups"}


def _tables(i: Inputs) -> Tables:
    return Tables(i.spark, scratch_path(i.spark, "tables"), buckets=4)


def _writes(chain: Chain, name: str, alias: str) -> DataFrame:
    return snapshot(chain.tables.people(name).pointer().select(*BATCH_KEYS, F.col(WRITE).alias(alias)), alias)


@query
def refresh_chain(i: Inputs) -> DataFrame:
    """Baselines refreshed after every fifth batch was changed and every other fifth deleted.

    ``rewritten`` tells whether the refresh wrote a batch, ``settled`` that another
    refresh wrote none.
    """
    tables = _tables(i)
    chain = Chain(tables)
    tables.replace("name_counts", i.ssa_raw)
    tables.replace_people("person_input", i.person_input)
    views = ("gender_baseline", "age_baseline_collapsed")
    for name in views:
        chain.refresh(name)
    first = _writes(chain, "gender_baseline", "first")
    changed = i.person_input.where("batch_id % 5 = 1").withColumn("first_name", F.reverse("first_name"))
    tables.replace_people("person_input", changed)
    tables.drop_batches("person_input", i.person_input.where("batch_id % 5 = 0").select(*BATCH_KEYS))
    for name in views:
        chain.refresh(name)
    second = _writes(chain, "gender_baseline", "second")
    for name in views:
        chain.refresh(name)
    third = _writes(chain, "gender_baseline", "third")
    writes = second.join(first, BATCH_KEYS, "left").join(third, BATCH_KEYS, "left")
    writes = writes.select(
        *BATCH_KEYS, (F.col("first") != F.col("second")).alias("rewritten"), (F.col("second") == F.col("third")).alias("settled")
    )
    genders = tables.read_people("gender_baseline").select(
        *baseline.RECORD_KEYS, "first_name_clean", "ssa_lookup_match_flag", "ssa_predicted_gender", "ssa_max_probability"
    )
    ages = tables.read_people("age_baseline_collapsed").select(*baseline.RECORD_KEYS, "ssa_predicted_age_bucket")
    return genders.join(ages, baseline.RECORD_KEYS, "full_outer").join(writes, BATCH_KEYS, "left")


def _open_batches(i: Inputs) -> DataFrame:
    return i.client_batch.where(F.col("delivery_complete_ts").isNull())


def _completing(i: Inputs, kind: type[Pipeline], status: str = "PENDING") -> tuple[Tables, Pipeline, DataFrame]:
    """Tables in which all undelivered batches wait for their completion, a pipeline and the queue."""
    tables = _tables(i)
    tables.replace("client", _as(i.client, schemas.CLIENT))
    tables.replace("client_batch", _as(_open_batches(i), schemas.BATCH))
    tables.replace_people("person_input", i.person_input)
    keys = _open_batches(i).select("client_id", F.col("id").alias("batch_id"))
    queue = _as(
        keys.withColumns({"processing_status": F.lit(status), "queued_ts": run_ts(), "error_message": F.lit("lost")}),
        schemas.COMPLETION_QUEUE,
    )
    tables.replace("completion_queue", queue)
    return tables, kind(tables, VERSION, run_ts, purge_raw=True), queue


class LostOnce(Pipeline):
    """A pipeline that loses its connection when it first posts messages."""

    lost = False

    def _post(self, messages: DataFrame, run: str) -> None:
        if not self.lost:
            self.lost = True
            raise ConnectionError("lost")
        super()._post(messages, run)


def _completed(tables: Tables, queue: DataFrame) -> DataFrame:
    """Of each batch its state, its count, its messages and the people left."""
    batches = tables.read("client_batch").select("client_id", F.col("id").alias("batch_id"), "processed_record_count")
    messages = tables.read("outbox").groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias("messages"))
    left = baseline.batch_record_counts(tables.read_people("person_input")).withColumnRenamed("record_count", "people_left")
    states = tables.read("completion_queue").select(*BATCH_KEYS, "processing_status", "error_message")
    out = queue.select(*BATCH_KEYS).join(states, BATCH_KEYS)
    for df in (batches, messages, left):
        out = out.join(df, BATCH_KEYS, "left")
    return out.fillna(0, ["messages", "people_left"])


@query
def repeated_completion(i: Inputs) -> DataFrame:
    """Completion that fails when it posts its messages, and its repeat."""
    tables, jobs, queue = _completing(i, LostOnce)
    try:
        jobs.complete(queue, "run")
        raise AssertionError("the first run should have failed")
    except ConnectionError:
        pass
    after = snapshot(_completed(tables, queue), "after-failure").select(
        *BATCH_KEYS, F.col("processing_status").alias("failed_status"), F.col("people_left").alias("people_after_failure")
    )
    jobs.complete(queue, "run")
    return _completed(tables, queue).join(after, BATCH_KEYS)


@query
def requeued_batch(i: Inputs) -> DataFrame:
    """Failed completions of which the even batches are put back and completed."""
    tables, jobs, queue = _completing(i, Pipeline, "FAILED")
    jobs.requeue("completion_queue", queue.where("batch_id % 2 = 0").select(*BATCH_KEYS), "again")
    jobs.complete(tables.changes("completion_queue"), "again")
    return _completed(tables, queue)


class AgesFailOnce(Pipeline):
    """A pipeline whose first enrichment with seven age groups fails."""

    failed = False

    def _enrich_age(self, code: str, keys: DataFrame) -> DataFrame:
        if code == enrichment.AGE_EXPANDED_CODE and not self.failed:
            self.failed = True
            raise ConnectionError("lost")
        return super()._enrich_age(code, keys)


@query
def three_enrichments(i: Inputs) -> DataFrame:
    """Three enrichments of all undelivered batches, one failing, and the repeat of the run."""
    tables = _tables(i)
    jobs = AgesFailOnce(tables, VERSION, run_ts)
    jobs.load_lookups(i.ssa_raw)
    tables.replace("client", _as(i.client, schemas.CLIENT))
    tables.replace("client_batch", _as(_open_batches(i), schemas.BATCH))
    tables.replace("enrichment_attribute", _as(i.attribute, schemas.ATTRIBUTE))
    tables.replace_people("person_input", i.person_input)
    kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("enrichment_type_code"), F.lit(n).alias("enrichment_type")) for c, n in TYPES.items()]))
    ordered = _open_batches(i).select("client_id", F.col("id").alias("batch_id"), "app_batch_id", kinds.alias("kind"))
    ordered = ordered.select("*", "kind.*", F.lit("PENDING").alias("enrichment_status")).drop("kind")
    ordered = tables.replace("enrichment_status", _as(ordered, schemas.ENRICHMENT_STATUS))
    ordered = snapshot(ordered, "ordered")
    try:
        jobs.start_enrichment(ordered, "run")
        raise AssertionError("the first run should have failed")
    except EnrichmentError:
        pass
    keys = [*BATCH_KEYS, "enrichment_type_code"]
    first = tables.read("enrichment_status").select(
        *keys, F.col("enrichment_status").alias("first_status"), F.col("error_message").alias("first_error")
    )
    first = snapshot(first, "first-statuses")
    jobs.start_enrichment(ordered, "run")
    results = None
    for code, name in zip(TYPES, ("gender_results", "age_results_expanded", "age_results_collapsed")):
        counts = baseline.batch_record_counts(tables.read_people(name)).withColumn("enrichment_type_code", F.lit(code))
        results = counts if results is None else results.unionByName(counts)
    waiting = tables.changes("completion_queue").groupBy(*BATCH_KEYS).agg(F.count(F.lit(1)).alias("times_queued"))
    last = tables.read("enrichment_status").select(*keys, "enrichment_status", "error_message")
    return last.join(first, keys).join(results.withColumnRenamed("record_count", "results"), keys, "left").join(waiting, BATCH_KEYS, "left")


@query
def purge_landing_job(i: Inputs) -> DataFrame:
    """Landed rows that stay: two files a batch in one run, the batches of every other client approved."""
    tables = _tables(i)
    jobs = Pipeline(tables, VERSION, run_ts)
    tables.replace("client", _as(i.client, schemas.CLIENT))
    second = F.concat(F.col("storage_file_name"), F.lit(".more.csv"))
    landed = i.landing.withColumn(
        "storage_file_name", F.when(F.col("record_id").cast("bigint") % 2 == 0, F.col("storage_file_name")).otherwise(second)
    )
    tables.emit("landing", landed, "uploads")
    jobs.process_files(tables.changes("landing"), "uploads")
    asked = tables.changes("approval_queue").select(*ingest.APPROVAL_KEYS)
    even = F.regexp_extract("app_organization_id", "([0-9]+)$", 1).cast("int") % 2 == 0
    tables.emit(
        "approval_results",
        asked.select("*", F.when(even, "APPROVED").otherwise("DENIED").alias("status"), run_ts().alias("decision_ts")),
        "decisions",
    )
    jobs.approve(tables.changes("approval_results"), "decisions")
    return tables.changes("landing").groupBy("storage_file_name").agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.col("record_id").cast("bigint")).alias("ids")
    )


@query
def metrics_upsert_stored(i: Inputs) -> DataFrame:
    """New metrics of the first client's batches written into a stored table; other parts are not rewritten."""
    tables = Tables(i.spark, scratch_path(i.spark, "tables"), buckets=64)
    people = snapshot(i.people, "people")
    tables.replace("gender_metrics", metrics.batch_metrics(people, VERSION, matched_only=False))
    new = snapshot(metrics.batch_metrics(people.where("client_id = 1"), VERSION), "new-metrics")
    before = tables._bucketed("gender_metrics").pointer()
    tables.change("gender_metrics", new, lambda rows: enrichment.upsert_metrics(rows, new))
    after = tables._bucketed("gender_metrics").pointer()
    touched = sum(before[part] != after[part] for part in before)
    batches = new.select(*BATCH_KEYS).distinct().count()
    return tables.read("gender_metrics").withColumn("few_parts", F.lit(0 < touched <= batches))


@query
def voter_file_load(i: Inputs) -> DataFrame:
    """A Latin-1 voter file of 33 fields written and loaded; lines with other numbers of fields are rejected."""
    root = scratch_path(i.spark, "voters")
    rows = i.voter_file
    fields = list(schemas.VOTER_FIELDS)
    kinds = {"whole": fields, "short": fields[:31], "long": [*fields, "extra_1", "extra_2"]}
    for kind, columns in kinds.items():
        out = rows.where(F.col("kind") == kind).withColumns({"extra_1": F.lit("x"), "extra_2": F.lit("y")}).select(*columns)
        out.write.option("sep", "|").option("encoding", "ISO-8859-1").option("header", True).csv(f"{root}/{kind}")
    loaded, rejected = load_voter_file(i.spark, f"{root}/*/", run_ts())
    loaded = loaded.drop("loaded_ts").withColumn("rejected", F.lit(None).cast("string"))
    return loaded.unionByName(rejected.select(F.col("line").alias("rejected")), allowMissingColumns=True)


@query
def config_variant(i: Inputs) -> DataFrame:
    """Ordered enrichments and export columns from configurations kept as variants.

    Some have fields nobody knows, some explicit nulls, some are no JSON.
    """
    attributes, fields = approval.config_parts(approval.variant_config(i.dirty_config))
    listed = attributes.groupBy(*ingest.APPROVAL_KEYS).agg(F.array_join(F.array_sort(F.collect_list("code")), ",").alias("codes"))
    place = F.struct(F.when(F.col("sort_order").isNull(), 0).otherwise(1), "sort_order", "field_name")
    ordered = fields.groupBy(*ingest.APPROVAL_KEYS).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(place)), lambda f: f["field_name"]), ",").alias("fields")
    )
    keys = i.dirty_config.select(*ingest.APPROVAL_KEYS)
    return keys.join(listed, ingest.APPROVAL_KEYS, "left").join(ordered, ingest.APPROVAL_KEYS, "left")


@query
def filled_record_ids(i: Inputs) -> DataFrame:
    """Landed rows of which every seventh came without an id."""
    rows = i.landing.withColumns(
        {
            "row": F.col("record_id"),
            "record_id": F.when(F.col("record_id").cast("bigint") % 7 != 0, F.col("record_id")),
        }
    )
    return fill_record_ids(rows, "storage_file_name", "row").select("storage_file_name", "row", "record_id")


@query
def export_column_lists(i: Inputs) -> DataFrame:
    """All batches written in one job, in three different column lists, and read back as lines."""
    lists = (["RECORD_ID", "PREDICTED_GENDER"], ["ZIP", "LAST_NAME", "RECORD_ID"], ["MALE_PROBABILITY", "FIRST_NAME", "RECORD_ID"])
    kind = F.col("batch_id") % 3
    wanted = F.when(kind == 0, F.lit(lists[0])).when(kind == 1, F.lit(lists[1])).otherwise(F.lit(lists[2]))
    keys = ingest.batch_keys(i.client, i.client_batch).withColumn("columns", wanted)
    rows = keyed_join(_download(i), keys, BATCH_KEYS, "inner")
    path = scratch_path(i.spark, "lists")
    export_lists(rows, path)
    schema = "value string, app_organization_id string, app_batch_id string"
    return i.spark.read.schema(schema).text(path).withColumnRenamed("value", "line")


@query
def ad_hoc_batch_load(i: Inputs) -> DataFrame:
    """The people of one client written as CSV and loaded by hand under given ids; rows without an id get one."""
    root = scratch_path(i.spark, "ad-hoc")
    people = i.person_input.where("client_id = 3").withColumn(
        "record_id", F.when(F.col("record_id").cast("string").rlike("[13579]$"), F.col("record_id"))
    )
    people.select("record_id", "first_name", "last_name", "zip").write.option("header", True).csv(f"{root}/keep")
    loaded = read_batch_file(i.spark, f"{root}/keep", 7, 70, run_ts(), glob="*.csv")
    known = F.length("record_id") < 64
    return loaded.groupBy("client_id", "batch_id", "load_ts").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(known).alias("with_own_id"),
        F.count_distinct(F.when(~known, F.col("record_id"))).alias("made_ids"),
        F.count_if(F.col("record_id").isNull()).alias("without_id"),
        F.sum(F.length("last_name")).alias("letters"),
    )


@query
def name_count_files(i: Inputs) -> DataFrame:
    """Birth counts written as CSV, found by a pattern of their names and loaded; summed per gender and year."""
    root = scratch_path(i.spark, "births")
    counts = i.ssa_raw.select("first_name", "gender", "quantity", "year")
    counts.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(f"{root}/births")
    counts.limit(1).write.csv(f"{root}/other")
    # A short list of paths.
    found = [r["path"] for r in list_files(i.spark, root, r"/births/part-[^/]*\.csv$").select("path").collect()]
    loaded = read_name_counts(i.spark, found)
    return loaded.groupBy("gender", "year").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("quantity").cast("bigint").alias("quantity"), F.sum(F.length("first_name")).alias("letters")
    )
