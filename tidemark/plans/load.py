"""One load from source to target, and many loads side by side."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import CREATED, DELETED, MODIFIED, Contract
from tidemark.operators import merge as m
from tidemark.operators.quality import CONVERSION, RAW_ROW, REASON, classify, dedupe_latest, duplicate_keys
from tidemark.plans.marks import MarkStore, highest
from tidemark.sources.extract import Delta, extract, run_hook, source_mark
from tidemark.sources.manifest import ManifestTable
from tidemark.sources.storage import SLICES, SharedFiles, VersionedTable, append_run, read_appended

FULL, INCREMENT, APPEND = "Full", "Increment", "Append"
SUCCEEDED, FAILED = "SUCCEEDED", "FAILED"
_REJECTS = T.StructType([T.StructField(REASON, T.StringType()), T.StructField(RAW_ROW, T.StringType())])

Hook = Callable[[SparkSession], object] | str | None


@dataclass(frozen=True)
class LoadSpec:
    """What to load and how.

    read: gives the source. One with a method ``after`` (see RelationalSource) is given the mark, so
    that it reads no more than the run needs.
    pattern: Full (replace the target), Increment (merge a diff), Append (add rows).
    missing_rows: what an Increment does to target keys the diff lacks. ``auto``
    soft-deletes them only when the diff is a snapshot of the source; a delta says
    nothing about the rows it does not hold. ``soft_delete`` is the literal rule.
    unique_source: the source is declared unique on its keys: no dedupe, and a
    repeated key fails the load before anything is merged.
    closed: a delta read ends at the highest value the source holds when the run
    starts, so rows that arrive meanwhile wait for the next run.
    keep_versions: how many versions of the target stay; all if not given.
    slice_by with slices, buckets: see VersionedTable; slices pay off for delta loads,
    buckets (a number) for snapshots of a table too large to shuffle on every run.
    file_rows: files by key range with a manifest, see ManifestTable; for delta loads of
    a table without an expression to slice by, whose keys have to be unique.
    """

    name: str
    contract: Contract
    read: Callable[[SparkSession], DataFrame]
    pattern: str = FULL
    delta: Delta | None = None
    where: str | None = None
    missing_rows: str = "auto"
    undelete: bool = False
    only_active: bool = False
    unique_source: bool = False
    slice_by: str | None = None
    slices: int = SLICES
    buckets: int | None = None
    file_rows: int | None = None
    keep_versions: int | None = None
    closed: bool = False
    pre_source: Hook = None
    post_source: Hook = None
    post_load: Hook = None

    def __post_init__(self) -> None:
        if self.pattern not in (FULL, INCREMENT, APPEND):
            raise ValueError(f"{self.name}: unknown pattern {self.pattern!r}")
        if self.pattern != FULL and self.delta is None and self.where is None:
            raise ValueError(f"{self.name}: {self.pattern} needs a delta column or a condition")
        if self.pattern == APPEND and not self.keeps_mark:
            raise ValueError(f"{self.name}: Append needs a delta column to resume from")
        if self.pattern != INCREMENT and (self.slice_by or self.buckets or self.file_rows):
            raise ValueError(f"{self.name}: slices, buckets and files by key range are layouts of merged tables")
        if self.file_rows and (self.slice_by or self.buckets):
            raise ValueError(f"{self.name}: files by key range are a layout of their own")
        if self.pattern == INCREMENT and not self.contract.keys:
            raise ValueError(f"{self.name}: Increment needs key columns")

    @property
    def keeps_mark(self) -> bool:
        return self.pattern != FULL and self.delta is not None and self.delta.kind != "constant"

    @property
    def target_delta(self) -> Delta:
        """The delta column under its name in the target."""
        names = {c.source_name: c.name for c in self.contract.data_columns}
        return Delta(names[self.delta.column], self.delta.kind)

    @property
    def is_snapshot(self) -> bool:
        """A constant delta stands for "read everything"; a custom condition or a real delta does not."""
        return self.where is None and self.delta is not None and self.delta.kind == "constant"

    @property
    def merge_rules(self) -> m.MergeRules:
        missing = self.missing_rows
        if missing == "auto":
            missing = "soft_delete" if self.is_snapshot else "ignore"
        return m.MergeRules(missing, self.undelete, self.only_active)


@dataclass
class LoadStats:
    """What one load read, loaded and set aside.

    Rows read (``src_success_rows``) = inserted + updated + unchanged + repeated + set
    aside (``tgt_failed_rows``). Repeated rows are those of a key that lost to a later
    one. ``src_failed_rows`` of the rows set aside held a value that could not be read
    in its declared type.
    """

    load_name: str
    src_success_rows: int = 0
    src_failed_rows: int = 0
    tgt_success_rows: int = 0
    tgt_failed_rows: int = 0
    total_trans_errors: int = 0
    first_error: str | None = None
    inserted_rows: int = 0
    updated_rows: int = 0
    deleted_rows: int = 0
    unchanged_rows: int = 0
    repeated_rows: int = 0
    mark: str | None = None
    start_time: datetime | None = None
    end_time: datetime | None = None
    status: str = SUCCEEDED
    # The size of the diff in memory, as it was landed; not part of the report.
    diff_bytes: int = field(default=0, repr=False)


STATS_SCHEMA = """load_name string, src_success_rows long, src_failed_rows long, tgt_success_rows long,
    tgt_failed_rows long, total_trans_errors long, first_error string, inserted_rows long, updated_rows long,
    deleted_rows long, unchanged_rows long, repeated_rows long, mark string, start_time timestamp_ntz, end_time timestamp_ntz, status string"""


@dataclass
class Stage:
    """A staging area: a root folder on shared storage and the session that works on it."""

    spark: SparkSession
    root: str
    marks: MarkStore = field(init=False)

    def __post_init__(self) -> None:
        self.root = self.root.rstrip("/")
        self.marks = MarkStore(self.spark, f"{self.root}/marks")

    def table(self, spec: LoadSpec) -> VersionedTable | ManifestTable:
        if spec.file_rows:
            return ManifestTable(self.spark, f"{self.root}/{spec.name}", spec.contract.target_schema(), spec.contract.keys, spec.file_rows)
        bucket_by = (spec.contract.keys, spec.buckets) if spec.buckets else None
        return VersionedTable(self.spark, f"{self.root}/{spec.name}", spec.contract.target_schema(), spec.slice_by, bucket_by, spec.slices)

    def target(self, spec: LoadSpec) -> DataFrame:
        if spec.pattern == APPEND:
            return read_appended(self.spark, f"{self.root}/{spec.name}", _append_schema(spec.contract))
        return self.table(spec).read()

    def diff(self, spec: LoadSpec) -> DataFrame:
        """The accepted rows of the last run of an Increment or Append."""
        return self._landed(spec).where(F.col(REASON).isNull()).select(*spec.contract.target_schema().names)

    def rejects(self, spec: LoadSpec) -> DataFrame:
        """The rows the last run set aside; ``reject_history`` has those of all runs."""
        if spec.pattern == FULL:
            return self.table(spec).set_aside(_REJECTS)
        return self._landed(spec).where(F.col(REASON).isNotNull()).select(REASON, RAW_ROW)

    def reject_history(self, spec: LoadSpec) -> DataFrame:
        """The rows that all runs set aside: the mark has passed them, or a later full load has replaced theirs."""
        return read_appended(self.spark, f"{self.root}/{spec.name}_rejects", _REJECTS)

    def run(self, spec: LoadSpec, session_start: str, merge_ts: str | None = None) -> LoadStats:
        """Extract, land, merge, then move the mark. Errors reach the caller.

        A diff is landed before anything else uses it, so the source is read once
        and counts, mark and merge all see the same rows; counts and mark are observed by the
        tasks that land it. A crash before the mark is committed replays the same rows into
        the same target.
        """
        stats = LoadStats(spec.name, start_time=_now())
        mark = self.marks.read(spec.name, spec.delta) if spec.keeps_mark else None
        run_hook(self.spark, spec.pre_source)
        rows = self._incoming(spec, mark, session_start)
        if spec.pattern == FULL:
            self._replace(spec, rows, stats)
        else:
            self._land(spec, rows, mark, stats)
        run_hook(self.spark, spec.post_source)

        if stats.tgt_failed_rows:
            append_run(self.rejects(spec), f"{self.root}/{spec.name}_rejects", _folder_name(f"{session_start} {mark}"))
        if spec.pattern == APPEND:
            # The mark a run starts from names it: a replay starts from the same one.
            rows = self.diff(spec).select(*spec.contract.names)
            append_run(rows, f"{self.root}/{spec.name}", _folder_name(mark))
            stats.inserted_rows = stats.tgt_success_rows
        elif spec.pattern == INCREMENT:
            self._merge(spec, merge_ts or session_start, stats)
        run_hook(self.spark, spec.post_load)
        if spec.keep_versions and spec.pattern != APPEND:
            self.table(spec).expire(spec.keep_versions)

        if spec.keeps_mark and stats.mark is not None and stats.mark != mark:
            self.marks.commit(spec.name, spec.delta, stats.mark, session_start)
        stats.end_time = _now()
        return stats

    def write_reject_file(self, spec: LoadSpec, path: str) -> None:
        """The rows set aside as text, one line each: the reason, a tab, the row as JSON."""
        self.rejects(spec).select(F.concat_ws("\t", REASON, RAW_ROW)).write.mode("overwrite").text(path)

    def run_all(
        self,
        specs: Sequence[LoadSpec],
        session_start: str,
        merge_ts: str | None = None,
        at_once: int = 8,
        refused: dict[str, str] | None = None,
    ) -> DataFrame:
        """Run loads side by side; one that fails leaves the others alone and shows in its statistics.

        Each load runs in its own scheduler pool, so under the FAIR mode a large
        table does not hold up the small ones. ``refused`` names loads that could not
        even be set up, with the cause; they are reported as failed.
        """
        # Two loads of one name would write one target: neither runs.
        named = Counter(s.name for s in specs)
        refused = {**(refused or {}), **{n: "two loads of the same name would write the same target" for n, c in named.items() if c > 1}}
        specs = [s for s in specs if named[s.name] == 1]

        def one(spec: LoadSpec) -> LoadStats:
            self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.name)
            started = _now()
            try:
                return self.run(spec, session_start, merge_ts)
            except Exception as error:  # noqa: BLE001 - any failure becomes this load's statistics
                text = str(error).strip().splitlines()[0] if str(error).strip() else type(error).__name__
                return LoadStats(spec.name, first_error=text, start_time=started, end_time=_now(), status=FAILED)

        with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(specs)))) as pool:
            done = list(pool.map(inheritable_thread_target(self.spark)(one), specs))
        done += [LoadStats(name, first_error=cause, start_time=_now(), end_time=_now(), status=FAILED)
                 for name, cause in refused.items()]
        return stats_frame(self.spark, done)

    def _incoming(self, spec: LoadSpec, mark: str | None, session_start: str) -> DataFrame:
        """This run's rows, converted, stamped and classified."""
        delta = spec.delta if spec.keeps_mark else None
        where = spec.where if spec.pattern != FULL else None
        past_mark = getattr(spec.read, "after", None) if delta is not None and where is None else None
        source = past_mark(self.spark, delta, mark) if past_mark else spec.read(self.spark)
        upper = source_mark(source, delta) if spec.closed and delta is not None and where is None else None
        rows = extract(source, spec.contract, delta=delta, mark=mark, upper=upper, where=where)
        return m.audit_stamp(classify(rows, spec.contract), session_start)

    def _replace(self, spec: LoadSpec, rows: DataFrame, stats: LoadStats) -> None:
        """Write the whole extract as the new target, accepted rows and rejects in the same pass, which also counts them.

        The source is read once, so what is counted is what is written even if it moves.
        """
        seen = Observation(f"load of {spec.name}")
        self.table(spec).write_tagged(rows.observe(seen, *_row_counts()), F.col(REASON).isNotNull(), [REASON, RAW_ROW])
        self._note(seen.get, stats)
        stats.inserted_rows = stats.tgt_success_rows

    def _land(self, spec: LoadSpec, rows: DataFrame, mark: str | None, stats: LoadStats) -> None:
        """Write the diff; the tasks that write it observe the counts and the highest delta value."""
        seen, counts = Observation(f"diff of {spec.name}"), _row_counts()
        counts.append(F.sum(F.when(F.col(REASON).isNull(), m.text_bytes(spec.contract.target_schema()))).alias("bytes"))
        if spec.keeps_mark:
            counts.append(spec.target_delta.as_text(F.max(spec.target_delta.value)).alias("top"))
        rows.observe(seen, *counts).write.mode("overwrite").parquet(self._diff_path(spec))
        found = seen.get
        self._note(found, stats)
        stats.diff_bytes = m.fixed_bytes(self.diff(spec), stats.tgt_success_rows) + (found["bytes"] or 0)
        if spec.pattern == INCREMENT and spec.unique_source:
            repeated = duplicate_keys(self.diff(spec), spec.contract.keys).agg(F.sum(F.col("row_count") - 1)).first()[0]
            if repeated:
                raise ValueError(f"{spec.name}: {repeated} rows repeat a key of a source declared unique")
        if spec.keeps_mark:
            stats.mark = found["top"] if found["top"] is not None else mark

    def _landed(self, spec: LoadSpec) -> DataFrame:
        fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in spec.contract.target_schema()]
        schema = ", ".join([*fields, f"{REASON} string", f"{RAW_ROW} string"])
        return self.spark.read.schema(schema).parquet(self._diff_path(spec))

    def _diff_path(self, spec: LoadSpec) -> str:
        return f"{self.root}/{spec.name}_diff"

    def _note(self, counts: dict, stats: LoadStats) -> None:
        stats.src_success_rows = counts["read"]
        stats.tgt_failed_rows = counts["bad"]
        stats.tgt_success_rows = counts["read"] - counts["bad"]
        stats.src_failed_rows = stats.total_trans_errors = counts["unreadable"]
        stats.first_error = counts["first_error"]

    def _merge(self, spec: LoadSpec, merge_ts: str, stats: LoadStats) -> None:
        rules, table, diff = spec.merge_rules, self.table(spec), self.diff(spec)
        self._check_unique(spec, table)
        slices = held = None
        if rules.not_matched_by_source == "ignore":
            if stats.tgt_success_rows == 0:
                return  # an empty delta changes nothing
            slices = table.slices_of(diff)
        elif stats.tgt_failed_rows:
            # The source still has these keys, so they have not vanished.
            held = self._landed(spec).where(F.col(REASON).isNotNull()).select(*spec.contract.keys)
        if not spec.unique_source:
            order = [spec.target_delta.value.desc_nulls_last()] if spec.keeps_mark else []
            diff = dedupe_latest(diff, spec.contract.keys, order)
        merged = m.merge(
            table.read(slices), diff, spec.contract.keys, merge_ts=merge_ts, rules=rules,
            keys_not_null=True,  # the contract rejects NULL keys before they land
            # A bucketed table is joined along its buckets, which keeps the layout.
            source_bytes=None if spec.buckets else stats.diff_bytes,
            with_action=True, with_matched=True, held=held)
        seen = Observation(f"merge of {spec.name}")
        hits = {a: F.count_if(F.col(m.ACTION) == a).alias(a) for a in (m.INSERTED, m.UPDATED, m.SOFT_DELETED)}
        same = F.count_if((F.col(m.ACTION) == m.UNCHANGED) & F.col(m.MATCHED)).alias(m.UNCHANGED)
        version = table.write(merged, last=lambda df: df.observe(seen, *hits.values(), same), replaces=slices)
        # Unique rows merged into unique ones stay so.
        SharedFiles(self.spark, self.root).touch(self._certificate(spec, version))
        stats.inserted_rows, stats.updated_rows, stats.deleted_rows = (seen.get[a] for a in hits)
        stats.unchanged_rows = seen.get[m.UNCHANGED]
        used = stats.inserted_rows + stats.updated_rows + stats.unchanged_rows
        stats.repeated_rows, stats.tgt_success_rows = stats.tgt_success_rows - used, used

    def _check_unique(self, spec: LoadSpec, table: VersionedTable | ManifestTable) -> None:
        """The merge relies on a target that is unique on its keys. A version that a merge wrote has a certificate of it; any
        other is checked once, and a repeated key fails the load before anything is merged."""
        versions = table.versions()
        files = SharedFiles(self.spark, self.root)
        if not versions or isinstance(table, ManifestTable) or files.exists(self._certificate(spec, versions[-1])):
            return
        repeated = duplicate_keys(table.read().select(*spec.contract.keys).dropna(), spec.contract.keys).limit(1).count()
        if repeated:
            raise ValueError(f"{spec.name}: the target repeats a key")
        files.touch(self._certificate(spec, versions[-1]))

    def _certificate(self, spec: LoadSpec, version: int) -> str:
        return f"{self.root}/{spec.name}_unique/v_{version:08d}-{_folder_name('-'.join(spec.contract.keys))}"


def _row_counts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("read"),
        F.count(REASON).alias("bad"),
        F.count_if(F.col(REASON).endswith(CONVERSION)).alias("unreadable"),
        F.min(REASON).alias("first_error"),
    ]


def stats_frame(spark: SparkSession, stats: Sequence[LoadStats]) -> DataFrame:
    """One row per load."""
    names = T.StructType.fromDDL(STATS_SCHEMA).names
    return spark.createDataFrame([tuple(asdict(s)[n] for n in names) for s in stats], STATS_SCHEMA)


def _append_schema(contract: Contract):
    schema = contract.target_schema()
    return type(schema)([f for f in schema if f.name in contract.names])


def _folder_name(mark: str) -> str:
    return "".join(ch if ch.isalnum() else "-" for ch in mark)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)
