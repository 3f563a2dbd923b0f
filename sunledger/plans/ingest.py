"""The batch job: events in, silver partitions, messages and reject tables out.

Many datasets are handled by a few Spark jobs. Only metadata reaches the driver:
the file paths and distinct headers of one wave, and the mappings they use.
Every event is checked, all versions of a dataset side by side; of those that
pass, the newest one that is not older than what silver holds is written.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.functions import uris
from sunledger.operators import accounting as A
from sunledger.operators import envelope as E
from sunledger.operators import positions as P
from sunledger.operators import quality as Q
from sunledger.operators import registry as R
from sunledger.operators import transform as X
from sunledger.operators.layout import RawLayout
from sunledger.session import materialise, prepare, work_dir
from sunledger.sinks import commits, folders, outgoing, quarantine, silver, versions
from sunledger.sinks import outcomes as O
from sunledger.sources import csv as C
from sunledger.sources import files as Fs

EVENT_COLUMNS = [
    "event_key", "event_id", "dataset_id", "registry_key", "source_vendor", "schema_version", "mapping_version",
    "correlation_id", "traceparent", "site_id", "category", "storage_path", "version", "event_time", "raw", "delivery",
]
# Jobs of one wave that run at the same time.
JOBS = 4


@dataclass(frozen=True)
class IngestConfig:
    """Where things are, and the switches of the semantics."""

    bronze_root: str
    silver_root: str
    outcome_root: str
    run_id: str  # a run that is repeated under its id replaces its own outcomes
    mode: str = "dataset"  # "dataset": one bad row rejects its dataset; "row": bad rows go to quarantine
    compat: bool = True  # False: unreadable ints, flags and times are failures instead of defaults
    partition_by: str = "ingestion_date"
    site_id_from_event: bool = False
    silver_uri_base: str = "https://storage.example.org/silver"
    outcome_uri_base: str = "https://storage.example.org/outcomes"
    ingestion_time: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    contract: E.EventContract = field(default_factory=E.EventContract)
    max_files_per_wave: int = 20_000
    max_layouts_per_job: int = 32

    @property
    def ingestion_date(self) -> str:
        return self.ingestion_time.astimezone(timezone.utc).strftime("%Y-%m-%d")

    @property
    def moment(self):
        text = self.ingestion_time.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        return F.lit(text).cast("timestamp")


def accept_events(spark: SparkSession, events: DataFrame, registry: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Every event with its file and mapping, or the first reason that rejects it.

    Adds ``reason``, ``payload``, ``file_path`` and the mapping columns. Reasons so far: the envelope checks, unknown schema, missing file.
    """
    base = work_dir(spark, "events")
    if "delivery" not in events.columns:
        events = events.withColumn("delivery", F.lit(1))
    checked = materialise(E.check_events(events, cfg.contract), f"{base}/checked")
    sound = checked.filter(F.col("reason").isNull())
    path = F.concat_ws("/", uris.container(F.col("storage_path")), uris.blob(F.col("storage_path")))
    resolved = R.resolve(sound, registry).withColumn("relative_path", path)
    parents = sound.select(F.regexp_replace(path, "/[^/]*$", "").alias("folder"))
    listing = Fs.list_files(spark, cfg.bronze_root, parents).select(
        "file_path", Fs.relative_path(F.col("file_path"), cfg.bronze_root).alias("relative_path"), "length"
    )
    listing = materialise(listing, f"{base}/listing")
    unlisted = resolved.filter(F.col("problem").isNull()).select("relative_path").join(listing, "relative_path", "left_anti")
    asked = Fs.locate(spark, cfg.bronze_root, unlisted, f"{base}/copies")
    located = resolved.join(listing.unionByName(asked), "relative_path", "left")

    unknown, absent = F.col("problem").isNotNull(), F.col("file_path").isNull()
    hollow = F.col("length") == 0
    reason = F.when(unknown, "UnknownSchema").when(hollow, "EmptyDataset").when(absent, "SourceFileNotFound")
    payload = F.when(
        unknown,
        F.to_json(
            F.struct(
                F.lit("UnknownSchema").alias("error_type"),
                "dataset_id",
                F.col("source_vendor").alias("vendor_id"),
                "schema_version",
                F.col("problem").alias("detail"),
            )
        ),
    )
    payload = payload.when(
        hollow, F.to_json(F.struct(F.lit("EmptyDataset").alias("error_type"), "dataset_id"))
    ).when(
        absent, F.to_json(F.struct(F.lit("SourceFileNotFound").alias("error_type"), "dataset_id", "storage_path"))
    )
    located = located.withColumn("reason", reason).withColumn("payload", payload)
    rejected = checked.filter(F.col("reason").isNotNull())
    return materialise(located.unionByName(rejected, allowMissingColumns=True), f"{base}/accepted")


@dataclass
class _Layout:
    """Files of one mapping that share a header and a way of reading."""

    number: int
    mapping: R.Mapping
    header: list[str]
    spanning: bool

    @property
    def raw(self) -> RawLayout:
        return RawLayout(self.header, C.text_column)

    @property
    def lacks_columns(self) -> bool:
        return not self.mapping.pass_through and bool(self.raw.missing(self.mapping))


def _together(function: Callable, items: Iterable) -> list:
    return folders.at_once(function, items, JOBS)


def _records(spark: SparkSession, files: DataFrame, base: str) -> DataFrame | None:
    """The records of files in which fields may span lines, one read for each delimiter."""
    found = files.filter("may_span_lines").select("delimiter", "path").distinct().collect()
    paths: dict[str, list[str]] = {}
    for row in found:
        paths.setdefault(row.delimiter, []).append(row.path)

    def read(n: int, delimiter: str) -> DataFrame:
        records = C.spanning_records(spark, sorted(paths[delimiter]), delimiter, f"{base}/lines-{n}")
        return materialise(records.withColumn("delimiter", F.lit(delimiter)), f"{base}/records-{n}")

    parts = _together(lambda x: read(*x), list(enumerate(sorted(paths))))
    whole = None
    for part in parts:
        whole = part if whole is None else whole.unionByName(part)
    return whole


def _with_layouts(
    spark: SparkSession, files: DataFrame, records: DataFrame | None, mappings: dict[str, R.Mapping], path: str
) -> tuple[DataFrame, list[_Layout]]:
    """``files`` with ``layout_no`` and ``header``, and the layouts; distinct headers of the wave are collected."""
    if records is not None:
        heads = records.filter("record = 1").select("file_path", "delimiter", F.col("value").alias("long_header"))
        files = files.join(heads, ["file_path", "delimiter"], "left")
        first = F.regexp_replace("long_header", "^\\x{feff}", "")
        files = files.withColumn("header_line", F.when(F.col("may_span_lines"), first).otherwise(F.col("header_line")))
        files = files.drop("long_header")
    files = materialise(files.withColumn("header_id", F.xxhash64("header_line")), path)
    layouts, rows = [], []
    kinds = files.select("registry_key", "header_id", "may_span_lines", "header_line").distinct()
    for n, head in enumerate(kinds.orderBy("registry_key", "header_line", "may_span_lines").collect()):
        mapping = mappings[head.registry_key]
        names = C.header_names(head.header_line or "", mapping.delimiter)
        layouts.append(_Layout(n, mapping, names, head.may_span_lines))
        rows.append((head.registry_key, head.header_id, head.may_span_lines, n, names))
    kinds = "registry_key string, header_id bigint, may_span_lines boolean, layout_no int, header array<string>"
    numbered = spark.createDataFrame(rows, kinds)
    # Written, so that the scans that meet it know how small it is and are not shuffled.
    return materialise(files.join(numbered, ["registry_key", "header_id", "may_span_lines"]), f"{path}-numbered"), layouts


def _stage(
    spark: SparkSession, group: list[_Layout], files: DataFrame, records: DataFrame | None, cfg: IngestConfig, path: str
) -> DataFrame:
    """Scan, check and convert the files of some layouts once; written to shared storage."""
    info = files.select(
        "file_path",
        "event_key",
        "layout_no",
        "dataset_id",
        F.col("schema_version").alias("event_schema_version"),
        F.col("site_id").alias("event_site_id"),
    )
    paths: dict[int, list[str]] = {}
    for row in files.select("layout_no", "path").distinct().filter(F.col("layout_no").isin([x.number for x in group])).collect():
        paths.setdefault(row.layout_no, []).append(row.path)
    staged = None
    for layout in group:
        width, delimiter, own = len(layout.header), layout.mapping.delimiter, info.filter(F.col("layout_no") == layout.number)
        if layout.spanning:
            kept = records.filter(F.col("delimiter") == delimiter).drop("delimiter").join(own, "file_path")
            rows = C.scan_records(kept, width, delimiter)
        else:
            rows = C.scan_rows(spark, sorted(paths[layout.number]), width, delimiter).join(own, "file_path")
        done = X.conform(
            rows.withColumn("checked_ms", F.expr("CAST(reflect('java.lang.System', 'currentTimeMillis') AS BIGINT)")),
            layout.mapping,
            layout.raw,
            carry=["event_key", "file_path", "block_start", "scan_id", "checked_ms"],
            dataset_id=F.col("dataset_id"),
            schema_version=F.col("event_schema_version"),
            ingestion_time=cfg.moment,
            compat=cfg.compat,
            site_id=F.col("event_site_id").cast("string") if cfg.site_id_from_event else None,
        )
        staged = done if staged is None else staged.unionByName(done, allowMissingColumns=True)
    return materialise(staged, path)


@dataclass
class _Checked:
    """What one job of a wave has written: its mapping, rows, verdicts, bad rows and failures."""

    key: str
    rows: DataFrame
    verdicts: DataFrame
    bad: DataFrame
    failures: DataFrame


def _check(
    spark: SparkSession, n: int, group: list[_Layout], files: DataFrame, records: DataFrame | None, cfg: IngestConfig, base: str
) -> _Checked:
    staged = _stage(spark, group, files, records, cfg, f"{base}/staged-{n}")
    offsets = materialise(P.split_offsets(staged), f"{base}/offsets-{n}")
    last = F.max("checked_ms").alias("checked_ms")
    verdicts = materialise(Q.verdicts(staged, "event_key", last), f"{base}/verdicts-{n}")
    bad = P.with_row_index(Q.bad_rows(staged), offsets)
    failures = materialise(Q.explode_failures(bad, "event_key"), f"{base}/failures-{n}")
    return _Checked(group[0].mapping.registry_key, staged, verdicts, bad, failures)


VERDICTS = """
    event_key string, row_count bigint, is_success boolean, pass_count bigint, fail_count bigint, bad_rows bigint, checked_ms bigint
"""


def _wave(
    spark: SparkSession, events: DataFrame, mappings: dict[str, R.Mapping], cfg: IngestConfig, base: str, part: str
) -> DataFrame:
    """Process the files of one wave; returns one outcome row per event."""
    started = int(time.time() * 1000)
    paths = [r.path for r in events.select("path").distinct().collect()]
    profile = materialise(C.profile_files(spark, paths), f"{base}/profile")
    profiled = int(time.time() * 1000)
    files = events.select(*EVENT_COLUMNS, "file_path", "path", "delimiter", "pass_through_unmapped", "column_mappings")
    files = materialise(files.join(profile, "file_path", "left"), f"{base}/files")
    empty = F.coalesce("data_lines", F.lit(0)) == 0
    foreign = F.col("detected_encoding").isNotNull()
    encoding = F.struct(F.lit("UnsupportedEncoding").alias("error_type"), "dataset_id", "detected_encoding")
    refused = files.filter(foreign | empty).select(
        *EVENT_COLUMNS,
        F.when(foreign, "UnsupportedEncoding").otherwise("EmptyDataset").alias("reason"),
        F.when(foreign, F.to_json(encoding))
        .otherwise(F.to_json(F.struct(F.lit("EmptyDataset").alias("error_type"), "dataset_id")))
        .alias("payload"),
        F.lit(profiled).cast("bigint").alias("checked_ms"),
    )
    readable = files.filter(~foreign & ~empty)
    records = _records(spark, readable, base)
    readable, layouts = _with_layouts(spark, readable, records, mappings, f"{base}/readable")

    strict = readable.filter(~F.col("pass_through_unmapped"))
    wanted = F.transform("column_mappings", lambda m: m["vendor_column"])
    failures = materialise(Q.header_failures(strict, wanted, "event_key"), f"{base}/header-failures")

    by_mapping: dict[str, list[_Layout]] = {}
    for layout in layouts:
        if not layout.lacks_columns:
            by_mapping.setdefault(layout.mapping.registry_key, []).append(layout)
    jobs = [
        group[i : i + cfg.max_layouts_per_job]
        for _, group in sorted(by_mapping.items())
        for i in range(0, len(group), cfg.max_layouts_per_job)
    ]
    checked: list[_Checked] = _together(
        lambda job: _check(spark, job[0], job[1], readable, records, cfg, base), list(enumerate(jobs))
    )
    verdicts = spark.createDataFrame([], VERDICTS)
    for c in checked:
        failures, verdicts = failures.unionByName(c.failures), verdicts.unionByName(c.verdicts)
    failures = materialise(failures, f"{base}/failures")
    outcome = materialise(_judge(readable, refused, failures, verdicts, cfg, started), f"{base}/outcome")
    outcome = _write_winners(spark, outcome, checked, cfg, base, part)
    _write_summary(outcome, failures, cfg, part)
    if cfg.mode == "row":
        for c in checked:
            bad = c.bad.withColumnRenamed("source_dataset_id", "dataset_id").drop("checked_ms")
            O.write_part(
                quarantine.quarantine_rows(bad), cfg.outcome_root, "quarantine_rows", cfg.run_id, part,
                by=["dataset_id"], mode="append",
            )
        _write_sidecars(outcome, failures, cfg, part)
    return outcome


def _write_winners(
    spark: SparkSession, outcome: DataFrame, checked: list[_Checked], cfg: IngestConfig, base: str, part: str
) -> DataFrame:
    """Put the newest passing event of each dataset in place of what silver holds, unless that is newer.

    Returns ``outcome`` with ``superseded``: whether a passing event gave way to
    a newer one, of this wave or an earlier commit.
    """
    root, commit = cfg.silver_root.rstrip("/"), f"{cfg.run_id}-{part}"
    held = materialise(versions.read_versions(spark, root), f"{base}/held")
    passed = outcome.filter(F.col("reason").isNull())
    before = held.select(
        "dataset_id", versions.order().alias("held_order"), F.col("registry_key").alias("held_key"), F.col("written_on").alias("held_on")
    )
    newest = versions.newest(passed.select("dataset_id", *versions.ORDER, "registry_key", "row_count", "bad_rows"))
    winners = newest.join(before, "dataset_id", "left").filter(
        F.col("held_order").isNull() | (versions.order() >= F.col("held_order"))
    )
    winners = materialise(winners.withColumn("written_on", F.lit(cfg.ingestion_date)), f"{base}/winners")

    staged = commits.begin(spark, root, commit)
    names = winners.select("event_key")
    written: dict[str, list] = {}

    def stage(c: _Checked) -> None:
        rows = Q.good_rows(c.rows) if cfg.mode == "row" else c.rows
        rows = rows.join(names, "event_key", "left_semi").drop(
            "event_key", "file_path", "block_start", "scan_id", "failures", "checked_ms"
        )
        silver.stage_silver(rows, staged, c.key, cfg.ingestion_date, cfg.partition_by)
        schema = rows.schema.add(cfg.partition_by, "string")
        written.setdefault(c.key, []).append(schema)

    # Jobs of one mapping write to one folder, one after the other.
    keys = sorted({c.key for c in checked})
    _together(lambda key: [stage(c) for c in checked if c.key == key], keys)
    noted, merged = versions.stage_versions(spark, winners, root, staged, commit)
    for key, schemas in sorted(written.items()):
        noted += silver.stage_schema(spark, schemas, root, staged, key, commit)
    placed = silver.staged_moves(spark, root, staged, keys, cfg.ingestion_date, cfg.partition_by)
    moved, removed = {*noted, *(target for _, target in placed)}, merged + _left_behind(spark, winners, cfg)
    commits.publish(spark, root, commit, noted + placed, [r for r in removed if r not in moved])

    beaten = passed.join(names, "event_key", "left_anti").select("event_key", F.lit(True).alias("superseded"))
    marked = outcome.join(beaten, "event_key", "left").withColumn("superseded", F.coalesce("superseded", F.lit(False)))
    marked = marked.withColumn("output_path", F.when(~F.col("superseded"), F.col("output_path")))
    return materialise(marked, f"{base}/marked")


def _left_behind(spark: SparkSession, winners: DataFrame, cfg: IngestConfig) -> list[str]:
    """Partitions that winners replace without writing them: those of another mapping, and those that have no row left."""
    whole = cfg.partition_by == "data_date"
    moved = (F.col("held_key") != F.col("registry_key")) & (F.lit(whole) | (F.col("held_on") == cfg.ingestion_date))
    bare = F.col("row_count") == (F.col("bad_rows") if cfg.mode == "row" else F.lit(0))
    gone = winners.select(
        "dataset_id", F.explode(F.array_compact(F.array(F.when(moved, F.col("held_key")), F.when(bare, F.col("registry_key"))))).alias("key")
    )
    return [
        silver.replaced_partition(spark, r.key, r.dataset_id, cfg.ingestion_date, cfg.partition_by) for r in gone.toLocalIterator()
    ]


def _judge(
    readable: DataFrame, refused: DataFrame, failures: DataFrame, verdicts: DataFrame, cfg: IngestConfig, started: int
) -> DataFrame:
    """Completed or rejected, with counts, the dead-letter payload and the time from the wave's start to the last row's check."""
    report = Q.failure_report(failures, "event_key").withColumnRenamed("fail_count", "failure_total")
    joined = readable.select(*EVENT_COLUMNS).join(verdicts, "event_key", "left").join(report, "event_key", "left")
    rejected_rows = F.col("failure_total").isNotNull()
    header_rejected = F.col("row_count").isNull() & rejected_rows
    failed = header_rejected if cfg.mode == "row" else rejected_rows
    no_rows = F.col("row_count").isNull() & ~rejected_rows
    reason = F.when(no_rows, "EmptyDataset").when(failed, "ValidationFailed")
    payload = F.when(
        no_rows, F.to_json(F.struct(F.lit("EmptyDataset").alias("error_type"), "dataset_id"))
    ).when(
        failed,
        F.to_json(
            F.struct(
                F.lit("ValidationFailed").alias("error_type"),
                "dataset_id",
                F.col("failure_total").alias("fail_count"),
                "failures",
            )
        ),
    )
    written = F.when(reason.isNull(), F.col("row_count") - (F.col("bad_rows") if cfg.mode == "row" else F.lit(0)))
    date = None if cfg.partition_by == "data_date" else F.lit(cfg.ingestion_date)
    uri = silver.partition_uri(cfg.silver_uri_base, F.col("registry_key"), F.col("dataset_id"), date)
    refused = refused.select(
        "*", *[F.lit(0).cast("bigint").alias(f"{c}") for c in ("records_processed", "validation_pass_count", "validation_fail_count")]
    )
    judged = joined.select(
        *EVENT_COLUMNS,
        reason.alias("reason"),
        payload.alias("payload"),
        F.coalesce(written, F.lit(0)).cast("bigint").alias("records_processed"),
        F.coalesce(written, F.lit(0)).cast("bigint").alias("validation_pass_count"),
        F.coalesce("failure_total", F.lit(0)).cast("bigint").alias("validation_fail_count"),
        F.when(reason.isNull(), uri).alias("output_path"),
        "row_count",
        "bad_rows",
        "checked_ms",
    )
    every = judged.unionByName(refused, allowMissingColumns=True)
    now = F.lit(int(time.time() * 1000))
    elapsed = F.greatest(F.coalesce("checked_ms", now) - F.lit(started), F.lit(0)).cast("bigint")
    return every.withColumn("processing_duration_ms", elapsed).drop("checked_ms")


def _write_summary(outcome: DataFrame, failures: DataFrame, cfg: IngestConfig, part: str) -> None:
    """Passes, failures and the reasons by rule of every event whose file was read, whatever its outcome."""
    by_rule = Q.summary(failures, "event_key").groupBy("event_key").agg(
        F.sort_array(F.collect_list(F.struct("rule", "failures", "failed_rows"))).alias("reasons")
    )
    counts = outcome.select(
        "event_key", "dataset_id", F.when(F.col("reason").isNull(), "Completed").otherwise("Failed").alias("status"),
        F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"), "validation_pass_count", "validation_fail_count",
    )
    none = F.array().cast("array<struct<rule:string,failures:bigint,failed_rows:bigint>>")
    report = counts.join(by_rule, "event_key", "left").withColumn("reasons", F.coalesce("reasons", none))
    O.write_part(report, cfg.outcome_root, "validation_summary", cfg.run_id, part)


def _write_sidecars(outcome: DataFrame, failures: DataFrame, cfg: IngestConfig, part: str) -> None:
    events = outcome.select(*EVENT_COLUMNS, "reason", "payload", "superseded")
    done = events.filter(F.col("reason").isNull() & ~F.col("superseded"))
    path = F.concat(
        F.lit(f"{cfg.outcome_uri_base.rstrip('/')}/quarantine_rows/run_id={cfg.run_id}/part={part}/dataset_id="),
        F.replace(F.url_encode("dataset_id"), F.lit("+"), F.lit("%20")),
    )
    found = failures.join(done.select("event_key", "dataset_id"), "event_key").drop("event_key")
    rows = quarantine.row_sidecars(found, done, cfg.moment, path)
    files = quarantine.file_sidecars(events.filter(F.col("reason").isNotNull()), cfg.moment)
    O.write_part(rows.unionByName(files), cfg.outcome_root, "quarantine_records", cfg.run_id, part)


def _publish(outcome: DataFrame, cfg: IngestConfig, part: str) -> None:
    """Notifications, dead letters and ledger rows of one part of a run."""
    full = outcome.select(
        "*",
        F.when(F.col("reason").isNull(), "Completed").otherwise("Failed").alias("status"),
        A.stage_of(F.col("reason")).alias("stage"),
    )
    completed = full.filter((F.col("status") == "Completed") & ~F.col("superseded")).select(
        "event_key", "dataset_id", F.col("records_processed").alias("record_count"),
        F.col("output_path").alias("silver_path"), "schema_version", "source_vendor", "correlation_id", "traceparent",
    )
    flat = outgoing.notifications(completed, cfg.moment, carry=["event_key"])
    O.write_part(flat, cfg.outcome_root, "notifications", cfg.run_id, part)
    O.write_part(outgoing.validated_envelopes(completed, cfg.moment), cfg.outcome_root, "validated_events", cfg.run_id, part)
    dead = full.filter(F.col("status") == "Failed").select(
        "event_key", "event_id", "dataset_id", "registry_key", "storage_path", "reason", "payload", "raw", "delivery"
    )
    O.write_part(dead, cfg.outcome_root, "dead_letter", cfg.run_id, part, by=["reason"])
    ledger = full.select(
        "event_key", "event_id", "dataset_id", "status", "stage", "reason", "records_processed",
        "validation_pass_count", "validation_fail_count", "processing_duration_ms", "output_path", "superseded",
        cfg.moment.alias("run_ts"),
    )
    O.write_part(ledger, cfg.outcome_root, "ledger", cfg.run_id, part)


def _reconcile(spark: SparkSession, accepted: DataFrame, cfg: IngestConfig) -> None:
    """Write the events of the run that do not have exactly one outcome, and outcomes of no event: an empty table when all is well."""
    found = [
        O.read_run(spark, cfg.outcome_root, table, cfg.run_id, "event_key string").select("event_key")
        for table in ("notifications", "dead_letter")
    ]
    ledger = O.read_run(spark, cfg.outcome_root, "ledger", cfg.run_id, O.LEDGER_SCHEMA)
    beaten = ledger.filter("superseded").select("event_key")
    odd = A.reconcile(accepted.select("event_key"), found[0].unionByName(found[1]).unionByName(beaten))
    O.write_part(odd, cfg.outcome_root, "reconciliation", cfg.run_id, "all")


def run_batch(spark: SparkSession, events: DataFrame, registry: DataFrame, config: IngestConfig) -> DataFrame:
    """Run the whole job; returns the ledger of this run.

    ``events``: ``raw`` and ``event_key``; ``registry``: see ``registry.REGISTRY_SCHEMA``.
    """
    prepare(spark)
    cfg = replace(config, bronze_root=config.bronze_root.rstrip("/"))
    base = work_dir(spark, f"run-{cfg.run_id}")
    commits.recover(spark, cfg.silver_root)
    O.clear_run(spark, cfg.outcome_root, cfg.run_id)
    accepted = accept_events(spark, events, registry, cfg)
    settled = accepted.filter(F.col("reason").isNotNull())
    counts = {
        c: F.lit(0).cast("bigint").alias(c)
        for c in ("records_processed", "validation_pass_count", "validation_fail_count", "processing_duration_ms")
    }
    _publish(
        settled.select(
            *[c for c in EVENT_COLUMNS],
            "reason",
            "payload",
            *counts.values(),
            F.lit(None).cast("string").alias("output_path"),
            F.lit(False).alias("superseded"),
        ),
        cfg,
        "events",
    )
    ready = accepted.filter(F.col("reason").isNull()).withColumn(
        "path", Fs.decoded_path(F.col("file_path"))
    )
    if cfg.mode == "row":
        O.write_part(quarantine.file_sidecars(settled, cfg.moment), cfg.outcome_root, "quarantine_records", cfg.run_id, "events")
    used = ready.select(*[f.split()[0] for f in ("registry_key", "delimiter", "pass_through_unmapped", "required_fields", "column_mappings")])
    mappings = {r.registry_key: R.Mapping.from_row(r) for r in used.dropDuplicates(["registry_key"]).collect()}
    # All events of a file fall into one wave, so each file is read once.
    waves = -(-ready.select("file_path").distinct().count() // cfg.max_files_per_wave)
    for w in range(waves):
        chosen = ready.filter(F.pmod(F.xxhash64("file_path"), F.lit(waves)) == w)
        name = f"wave-{w}"
        _publish(_wave(spark, chosen, mappings, cfg, f"{base}/{name}", name), cfg, name)
        folders.delete(spark, f"{base}/{name}")
    _reconcile(spark, accepted, cfg)
    return O.read_run(spark, cfg.outcome_root, "ledger", cfg.run_id, O.LEDGER_SCHEMA)
