"""One load of one dataset, from source files to published rows and an audit row.

The source is read once, for the staging copy. The rows to be judged come from the part
of the staging copy that this run published: already filtered, in columns, and without the
rows of earlier loads.

Appends carry the run's identity, so a run that is repeated takes the place of what it
appended before.

Judged rows are written to shared scratch space, partitioned by outcome, so that the
curated and the reject writer each read only their own rows and the keyed dedupe
shuffles once. Without rules all rows are valid, and go to curated files directly. All
counts come from these writes. Each count sits in the stage that writes, behind the
last shuffle, so tasks that are run again after losing an executor do not count twice.

All steps are planned before the first write, so a specification that does not fit its
source fails while everything is as it was.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import col, find, orderable, require
from ..functions.masks import UNMASKED, level_of
from ..functions.tags import TAG_COLUMN
from ..operators.conform import conform_columns, mask_sensitive
from ..operators.latest import latest_per_key
from ..operators.quality import (
    LOST,
    OUTCOME,
    REASONS,
    REJECT,
    VALID,
    judge,
    outcome_metrics,
    rejected_rows,
    rule_metrics,
    rule_names,
    valid_rows,
)
from ..operators.reports import SchemaIssue, conformance_metrics, raise_on_error, schema_issues
from ..operators.rows import STAMP_COLUMNS, keep_where, with_domicile
from ..runtime import drop_scratch, scratch_dir, sized_for
from ..sinks.audit import append_audit
from ..sinks.curated import with_earlier_columns, write_curated_files
from ..sinks.published import Dataset, read_published
from ..sinks.rejects import (
    RUN_COLUMNS,
    publish_rejects,
    write_rejects,
    write_rejects_partition,
)
from ..sinks.staging import write_staging
from ..sinks.tables import publish_table, read_table, table_name, unknown_columns
from ..sources.files import MALFORMED, read_source
from ..spec import DatasetSpec, TableSpec

log = logging.getLogger(__name__)
_HOUR = [T.StructField(name, T.StringType()) for name in RUN_COLUMNS]
_LOG_LEVELS = {"info": logging.INFO, "warn": logging.WARNING, "error": logging.ERROR}


@dataclass(frozen=True)
class LoadPaths:
    """Where one dataset's outputs go."""

    staging: str
    curated: str
    rejects: str
    audit: str

    @classmethod
    def under(cls, base: str, dataset: str) -> LoadPaths:
        base = base.rstrip("/")
        return cls(
            staging=f"{base}/staging/{dataset}",
            curated=f"{base}/curated/{dataset}",
            rejects=f"{base}/curated/{dataset}_rejects",
            audit=f"{base}/audit",
        )


@dataclass(frozen=True)
class LoadOptions:
    """Choices for one run."""

    full_load: bool = False
    sys_level: str = "dev"
    #: Moment the load is stamped with; now, if not given.
    load_ts: datetime | None = None
    #: Mask sensitive columns of curated and rejected rows, after the quality rules.
    mask: bool = False
    #: Fail on missing columns and on row-count mismatch instead of warning.
    strict: bool = False
    #: Keep rejects per hour (``dt=…/hr=…``) instead of only the last run's.
    rejects_by_hour: bool = False
    #: Database and table through which rejects can be queried; none, if not given.
    rejects_table: tuple[str, str] | None = None
    cast_mode: str = "try"
    csv_types: str = "declared"
    #: Identity of the run. What an incremental run adds to files takes the place of what
    #: a run of the same identity added before. ``load_ts``, if not given; a run with
    #: neither is like no other.
    run_id: str | None = None

    @property
    def run(self) -> str | None:
        if self.run_id is None and self.load_ts is not None:
            return self.load_ts.isoformat()
        return self.run_id


@dataclass
class LoadResult:
    """What a run did. Counts are None until the write they ride on is done."""

    dataset: str
    paths: LoadPaths
    source: int | None = None
    valid: int | None = None
    rejected: int | None = None
    lost: int | None = None
    #: CSV lines with text that did not fit a declared type, and was read as NULL.
    malformed: int = 0
    rule_failures: dict[str, int] = field(default_factory=dict)
    schema_issues: list[SchemaIssue] = field(default_factory=list)
    nulls: dict[str, int] = field(default_factory=dict)
    bad_casts: dict[str, int] = field(default_factory=dict)
    curated_schema: T.StructType | None = None
    rejects_schema: T.StructType | None = None
    #: The table that curated rows went to, if not to files.
    target: TableSpec | None = None

    @property
    def table(self) -> str | None:
        return None if self.target is None else table_name(self.target)

    @property
    def not_published(self) -> int | None:
        """Source rows that did not reach the curated output, for whatever reason."""
        return None if self.valid is None else self.source - self.valid

    @property
    def loss_pct(self) -> float:
        return round(self.not_published / self.source * 100, 2) if self.source else 0.0

    #: ``(dt, hr)`` of this run's rejects, if they are kept by hour.
    hour: tuple[str, str] | None = None

    def curated(self, spark: SparkSession) -> DataFrame:
        """All curated rows there are now, with the columns of this and earlier runs."""
        if self.target is not None:
            return read_table(spark, self.target)
        schema = with_earlier_columns(spark, self.paths.curated, self.curated_schema)
        return read_published(spark, self.paths.curated, schema)

    def staged(self, spark: SparkSession) -> DataFrame:
        """The raw copies of this and earlier runs, with their load stamps."""
        return read_published(spark, self.paths.staging)

    def rejects(self, spark: SparkSession, all_hours: bool = False) -> DataFrame:
        """This run's rejects; with ``all_hours`` those of every hour that is kept."""
        found = read_published(spark, self.paths.rejects, self.rejects_schema)
        if self.hour is None or all_hours:
            return found
        return found.filter((F.col("dt") == self.hour[0]) & (F.col("hr") == self.hour[1]))


def run_load(
    spark: SparkSession,
    spec: DatasetSpec,
    base_path: str,
    options: LoadOptions = LoadOptions(),
) -> LoadResult:
    """Run one full or incremental load; failures are audited, then raised."""
    clock, utc = _moment(spark, options.load_ts)
    result = LoadResult(spec.name, LoadPaths.under(base_path, spec.name))
    scratch = scratch_dir(spark, f"judged-{spec.name}")
    status = "FAILED"
    try:
        source = read_source(
            spark,
            spec.source_path,
            spec.format,
            spec.columns,
            options.csv_types,
            keep_malformed=True,
        )
        tagged = with_domicile(keep_where(source, spec.where), spec.domicile)
        _check_plan(tagged.drop(MALFORMED), spec, options)
        with sized_for(spark, source):
            staged = _stage(tagged, spec, options, clock, result)
            single_tag = find(source, TAG_COLUMN) is None
            rows = _deduped(staged, spec, options)
            if _all_valid(rows, spec, options):
                rejected = _write_all(rows, spec, options, single_tag, result)
                _check_counts(spec, options, result)
            else:
                judged = _judge(rows, spec, options, scratch, result)
                _check_counts(spec, options, result)
                _publish(valid_rows(judged), spec, options, single_tag, result)
                rejected = rejected_rows(judged, reasons=True)
            _write_rejects(rejected, options, clock, result)
        status = "SUCCESS"
    finally:
        try:
            append_audit(
                spark,
                result.paths.audit,
                spec.name,
                options.sys_level,
                result.source,
                result.valid,
                result.rejected,
                status,
                utc,
            )
        finally:
            drop_scratch(spark, scratch)
    return result


def _moment(spark: SparkSession, load_ts: datetime | None) -> tuple[datetime, datetime]:
    """The load's wall-clock time in the session time zone, and its UTC time."""
    if load_ts is not None and load_ts.tzinfo is None:
        return load_ts, load_ts
    instant = load_ts or datetime.now(timezone.utc)
    clock = spark.sql("SELECT 1").select(F.lit(instant).cast("timestamp_ntz")).first()[0]
    return clock, instant.astimezone(timezone.utc).replace(tzinfo=None)


def _moved_aside(df: DataFrame) -> dict[str, str]:
    """New names, in the staging copy only, of source columns named like the load stamp."""
    return {c: f"source_{c}" for c in df.columns if c.lower() in STAMP_COLUMNS}


def _check_plan(rows: DataFrame, spec: DatasetSpec, options: LoadOptions) -> None:
    """Plan every step once, without running it, and refuse names that would collide."""
    deduped = _deduped(rows, spec, options)
    judged = judge(deduped, spec.columns, spec.dq_mode)
    if options.mask:
        judged = mask_sensitive(judged, spec.columns)
    assert judged.schema
    reserved = [REASONS, OUTCOME, *(RUN_COLUMNS if options.rejects_by_hour else ())]
    taken = [c for c in deduped.columns if c.lower() in reserved]
    aside = _moved_aside(rows).values()
    taken += [c for c in rows.columns if c in aside]
    if taken:
        raise ValueError(f"{spec.name}: the load needs the column name {', '.join(taken)} itself")
    if spec.table is None:
        return
    if not options.full_load:
        require(deduped, spec.merge_keys(), f"{spec.name}: table key")
    if not spec.table.evolve:
        unknown = unknown_columns(deduped, spec.table)
        if unknown:
            raise ValueError(f"{table_name(spec.table)} has no column {', '.join(unknown)}")


def _stage(
    tagged: DataFrame,
    spec: DatasetSpec,
    options: LoadOptions,
    clock: datetime,
    result: LoadResult,
) -> DataFrame:
    """Write the staging copy; returns the rows of this load for the next step."""
    rows = tagged.drop(MALFORMED)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if MALFORMED in tagged.columns:
        metrics.append(F.count(MALFORMED).alias("malformed"))
    if spec.check_schema:
        result.schema_issues = schema_issues(
            rows, spec.columns, spec.allow_extra_columns, spec.allow_missing_columns
        )
        for issue in result.schema_issues:
            if issue.issue != "ok":
                level = _LOG_LEVELS[issue.severity]
                log.log(level, "%s: %s column %s", spec.name, issue.issue, issue.column)
        if options.strict:
            raise_on_error(result.schema_issues)
        metrics += conformance_metrics(rows, spec.columns)
    seen = Observation()
    watched = tagged.observe(seen, *metrics)
    aside = _moved_aside(rows)
    copied = watched.drop(MALFORMED).withColumnsRenamed(aside)
    part = write_staging(copied, result.paths.staging, options.full_load, clock, options.run)
    counts = seen.get
    result.source = counts["rows"]
    result.malformed = counts.get("malformed", 0)
    if result.malformed:
        log.warning("%s: %d malformed CSV lines", spec.name, result.malformed)
    for i, column in enumerate(spec.columns):
        if f"nulls_{i}" in counts:
            result.nulls[column.source] = counts[f"nulls_{i}"]
            result.bad_casts[column.source] = counts[f"bad_casts_{i}"]
    staged = Dataset(rows.sparkSession, result.paths.staging).read(part.schema, [part])
    return staged.select(*[col(aside.get(c, c)).alias(c) for c in rows.columns])


def _deduped(rows: DataFrame, spec: DatasetSpec, options: LoadOptions) -> DataFrame:
    """Conformed rows, the latest per key. Columns that are masked and that no rule looks
    at do not break ties, so that they need not be read."""
    conformed = conform_columns(rows, spec.columns, options.cast_mode)
    ties = None
    if options.mask:
        unread = {
            find(conformed, c.target)
            for c in spec.columns
            if level_of(c.sensitivity) != UNMASKED and c.nullable and not c.regex
        }
        used = {*spec.id_columns, *spec.update_columns}
        ties = [
            f.name for f in conformed.schema
            if f.name not in unread and f.name not in used and orderable(f.dataType)
        ]
    return latest_per_key(conformed, spec.id_columns, spec.update_columns, ties)


def _all_valid(rows: DataFrame, spec: DatasetSpec, options: LoadOptions) -> bool:
    """No rule to judge by, files to write to, and no count that could stop it first."""
    stopped = options.strict and spec.check_row_count
    return not rule_names(rows, spec.columns, spec.dq_mode) and spec.table is None and not stopped


def _write_all(
    rows: DataFrame,
    spec: DatasetSpec,
    options: LoadOptions,
    single_tag: bool,
    result: LoadResult,
) -> DataFrame:
    """Write rows that are all valid; returns the rejects, none."""
    none = rejected_rows(judge(rows.filter(F.lit(False)), spec.columns, spec.dq_mode), reasons=True)
    if options.mask:
        rows, none = (mask_sensitive(df, spec.columns) for df in (rows, none))
    seen = Observation()
    result.curated_schema = write_curated_files(
        rows,
        result.paths.curated,
        options.full_load,
        spec.domicile,
        single_tag,
        watch=lambda df: df.observe(seen, F.count(F.lit(1)).alias(VALID)),
        run=options.run,
    )
    result.valid, result.rejected, result.lost = seen.get[VALID], 0, 0
    return none


def _judge(
    rows: DataFrame,
    spec: DatasetSpec,
    options: LoadOptions,
    scratch: str,
    result: LoadResult,
) -> DataFrame:
    judged = judge(rows, spec.columns, spec.dq_mode)
    rules = rule_names(rows, spec.columns, spec.dq_mode)
    if options.mask:
        judged = mask_sensitive(judged, spec.columns)
    seen = Observation()
    judged = judged.observe(seen, *outcome_metrics(), *rule_metrics(rules))
    judged.write.partitionBy(OUTCOME).parquet(scratch)
    counts = seen.get
    result.valid, result.rejected, result.lost = counts[VALID], counts[REJECT], counts[LOST]
    result.rule_failures = {rule: counts[rule] for rule in rules}
    return rows.sparkSession.read.schema(judged.schema).parquet(scratch)


def _check_counts(spec: DatasetSpec, options: LoadOptions, result: LoadResult) -> None:
    if not spec.check_row_count or result.source == result.valid:
        return
    message = (
        f"{spec.name}: {result.not_published} of {result.source} rows "
        f"({result.loss_pct}%) are not published"
    )
    if options.strict:
        raise ValueError(message)
    log.warning(message)


def _publish(
    valid: DataFrame,
    spec: DatasetSpec,
    options: LoadOptions,
    single_tag: bool,
    result: LoadResult,
) -> None:
    if spec.table is None:
        result.curated_schema = write_curated_files(
            valid, result.paths.curated, options.full_load, spec.domicile, single_tag, run=options.run
        )
        return
    keys = () if options.full_load else spec.merge_keys()
    publish_table(valid, spec.table, options.full_load, keys, spec.domicile, single_tag)
    result.target = spec.table
    result.curated_schema = valid.schema


def _write_rejects(
    rejected: DataFrame, options: LoadOptions, clock: datetime, result: LoadResult
) -> None:
    path, hour = result.paths.rejects, ()
    result.rejects_schema = rejected.schema
    if options.rejects_by_hour:
        hour = result.hour = clock.strftime("%Y-%m-%d"), clock.strftime("%H")
        result.rejects_schema = T.StructType([*rejected.schema, *_HOUR])
    if options.rejects_table is not None:
        publish_rejects(rejected, path, *options.rejects_table, *hour)
    elif hour:
        write_rejects_partition(rejected, path, *hour)
    else:
        write_rejects(rejected, path)
