"""One ELT run: landing → raw (SCD2) → silver → gold → checks → export.

Every step reads its inputs from the warehouse tables written by the step
before, so lineage never grows across steps. All tables are versioned
(``sinks.versions``), so a step's result appears at once or not at all. A
failed run is simply run again: landing files are recorded as taken in after
all tables are complete, snapshots and upserts are no-ops on equal input,
appends are guarded by anti joins on their keys, and the silver tables'
watermarks come from commit records that are written after all their rows,
so rows that a crashed run did not get to are still newer than the watermark.

A run does what its input asks for: without new landing files nothing is
read; without a new raw version the silver tables stay; reports, checks and
exports are made again only if a table below them (or the run date) has
changed.

Warehouse layout (``Layout.warehouse``)::

    raw/_landing_files        landing files taken in (path, length, time)
    raw/raw_stores_snapshot   bucketed by store_token; open and closed rows apart
    raw/raw_sales_snapshot    bucketed by transaction_uid; open and closed rows apart
    raw/raw_file_audit        append-only, a folder per kind of file
    silver/silver_stores      bucketed by store_token
    silver/silver_sales       bucketed by (store_token, transaction_id)
    silver/silver_sales_rejected        append-only
    silver/silver_sales_audit_by_batch  made from counts by batch
    gold/_*_by_*                        sums and counts kept by signed deltas
    gold/rpt_*                          made from those
"""

from __future__ import annotations

import json
import threading
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as C
from ledgerline.operators.checks import run_checks
from ledgerline.operators.incremental import FLOOR_TS, append_new
from ledgerline.operators.maintained import refresh
from ledgerline.operators.scd2 import current_versions, with_scd_columns
from ledgerline.operators.validate import rejected_sales, stage_sales, valid_sales, valid_stores
from ledgerline.plans import raw as RAW
from ledgerline.plans import reports as R
from ledgerline.plans.audit import files_of
from ledgerline.plans.quality import GOLD_RULES, SILVER_RULES
from ledgerline.session import work_dir
from ledgerline.sinks import tables as TB
from ledgerline.sinks.export import export_tables
from ledgerline.sinks.versions import KEEP, VersionedTable
from ledgerline.sources import ingest
from ledgerline.sources.landing import read_landing
from ledgerline.sources.tables import register_views

SALES_KEYS = ["store_token", "transaction_id"]
KIND = "kind"                           # folder level of the file audit
WATERMARK = "watermark"                 # commit record: all rows up to this stamp are in
BUILT = "built"                         # commit record: what the reports were made from
REJECTED_KEYS = ["store_token", "transaction_id", "snapshot_updated_at"]


@dataclass
class Layout:
    landing: str
    warehouse: str
    exports: str | None = None
    n_buckets: int = 64
    store_buckets: int = 4
    multi_line: bool | str = "auto"      # which landing files are read whole (see sources.landing)
    compact_above_files: int = 32        # per bucket; 0 disables compaction
    keep_versions: int = KEEP            # of each table; older ones expire after a run

    def path(self, layer: str, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{layer}/{name}"


@dataclass
class RunResult:
    tables: dict[str, str] = field(default_factory=dict)
    checks: list = field(default_factory=list)


class CheckFailed(RuntimeError):
    pass


def _ts(run_ts):
    return F.lit(str(run_ts)).cast("timestamp_ntz")


_SCRATCH: dict[int, list[str]] = {}     # per driver thread: runs may be concurrent


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared work folder and read it back: a lineage
    cut that survives executor loss (unlike a cache or local checkpoint).
    The folders are removed at the end of the run."""
    path = work_dir(spark, name)
    df.write.mode("overwrite").parquet(path)
    _SCRATCH.setdefault(threading.get_ident(), []).append(path)
    return spark.read.parquet(path)


def _drop_scratch(spark: SparkSession) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    mine = _SCRATCH.pop(threading.get_ident(), [])
    while mine:
        p = jvm.org.apache.hadoop.fs.Path(mine.pop())
        p.getFileSystem(conf).delete(p, True)


def _insert(table: TB.BucketedTable, rows: DataFrame, base) -> None:
    """Add rows as a new version. Without any there is none, but for the
    first, which tells the columns."""
    run = table.write(rows, base)
    if base is None or table.parts_of(run):
        table.publish(base, run, rows.schema)


# ------------------------------------------------------------- raw (SCD2) ---

def snapshot_into(spark: SparkSession, table: TB.BucketedTable, incoming: DataFrame,
                  key: str, check_cols: list[str], run_ts) -> dict:
    """Apply one snapshot run to a bucketed SCD2 table with segments.

    The open versions that a key of the input may have are looked up (by
    bucket and by the files' key filters). Rows of new keys and new versions
    are inserted; a changed key's open version is closed, which rewrites the
    open rows of its bucket and adds one closed row. Closed rows are never
    read or written again. All of it is one write and one new version. A
    table without open rows has nothing to compare with: the input is
    written as it is.
    """
    ts, base = _ts(run_ts), table.manifest()
    if base is None or not any(table.is_open(p) for p in base.parts):
        _insert(table, with_scd_columns(incoming, key, ts).withColumn(TB.SEGMENT, F.lit(TB.OPEN)), base)
        return {"inserted": None, "changed_buckets": 0, "files_read": 0}
    incoming = materialize(spark, table.with_bucket(incoming), "snapshot-input")
    found = table.lookup(incoming, base)
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"__c_{c}"))
    new = incoming.withColumn("__known", F.lit(False))
    if found.rows is not None:
        cur = found.rows.select(F.col(key).alias("__k"), F.col(TB.BUCKET).alias("__b"),
                                *[F.col(c).alias(f"__c_{c}") for c in check_cols])
        joined = incoming.join(cur, (F.col(TB.BUCKET) == F.col("__b")) & (F.col(key) == F.col("__k")), "left")
        new = joined.where(F.col("__k").isNull() | ~same).withColumn("__known", F.col("__k").isNotNull()) \
            .select(*incoming.columns, "__known")
    new = materialize(spark, new, "snapshot-delta")
    if new.isEmpty():                        # replay of known content: nothing to write
        return {"changed_buckets": 0, "files_read": found.files_read}
    changed = new.where("__known")
    touched = set(TB.touched_buckets(changed))
    content = with_scd_columns(new.drop("__known"), key, ts).withColumn(TB.SEGMENT, F.lit(TB.OPEN))
    if touched:
        old = table.read(base, keep=lambda p: table.is_open(p) and table.bucket(p) in touched)
        closing = changed.select(F.col(key).alias("__k"), F.col(TB.BUCKET).alias("__b"))
        old = old.join(closing, (F.col(TB.BUCKET) == F.col("__b")) & (F.col(key) == F.col("__k")), "left")
        closed = F.col("__k").isNotNull()
        old = old.withColumn("dbt_valid_to", F.when(closed, ts).otherwise(F.col("dbt_valid_to"))) \
            .withColumn(TB.SEGMENT, F.when(closed, TB.CLOSED).otherwise(TB.OPEN)).drop("__k", "__b")
        content = content.unionByName(old, allowMissingColumns=True)
    table.change(content, drop=lambda p: table.is_open(p) and table.bucket(p) in touched, base=base)
    return {"changed_buckets": len(touched), "files_read": found.files_read}


# ----------------------------------------------------------------- silver ---

def upsert_into(spark: SparkSession, table: TB.BucketedTable, new: DataFrame,
                keys: list[str]) -> dict:
    """delete+insert by ``keys``: rows of existing keys are replaced (their
    buckets rewritten), rows of new keys added, as one new version."""
    base = table.manifest()
    if base is None or not base.parts:
        _insert(table, new, base)
        return {"replaced_buckets": 0}
    new = materialize(spark, table.with_bucket(new), "upsert-delta")
    if new.isEmpty():
        return {"replaced_buckets": 0}
    found = table.lookup(new, base)
    touched: set[int] = set()
    on = [TB.BUCKET, *keys]
    if found.rows is not None:
        touched = set(TB.touched_buckets(found.rows.select(*on).join(new.select(*on), on, "left_semi")))
    content = new
    if touched:
        old = table.read(base, keep=lambda p: table.bucket(p) in touched)
        content = old.join(new.select(*on), on, "left_anti").unionByName(new, allowMissingColumns=True)
    table.change(content, drop=lambda p: table.bucket(p) in touched, base=base)
    return {"replaced_buckets": len(touched)}


def append_rows(spark: SparkSession, table: VersionedTable, new: DataFrame, keys: list[str],
                since: int = 0, newer: Column | None = None) -> None:
    """Idempotent append: rows whose ``keys`` are already present are skipped.

    Only rows that a crashed run may have left can be present, so a caller
    that knows what is complete restricts the target: to parts added since
    a version, and to rows for which ``newer`` holds."""
    base = table.manifest()
    if base is not None:
        target = table.read(base, keep=lambda p: p.since >= since)
        target = target if newer is None else target.where(newer)
        new = materialize(spark, new, "append-input")
        if new.isEmpty():
            return
        new = append_new(target, new, keys)
    table.change(new, base=base)


# ------------------------------------------------------------------- run ---

def run_daily(spark: SparkSession, layout: Layout, run_ts, run_date=None,
              checks: str = "after_all", strict_batch_date: bool = True,
              export: bool = True, files: Sequence[tuple[str, int, int]] | None = None) -> RunResult:
    """Run every model once at ``run_ts`` (a strictly increasing stamp per
    run) on the landing files that no run has taken in yet (``files``: on
    those of these (URI, length, modification time) alone). ``checks``: "after_all" (raise on failed error-severity rules
    after all models), "after_each" (after each model group, stopping at
    the first failure) or "off"."""
    try:
        return _run(spark, layout, run_ts, run_date, checks, strict_batch_date, export, files)
    finally:
        _drop_scratch(spark)


def _tables(layout: Layout, spark: SparkSession) -> dict:
    P = layout.path
    return {
        "raw_stores": TB.BucketedTable(spark, P("raw", "raw_stores_snapshot"),
                                       [RAW.STORES_KEY], layout.store_buckets, segments=True, filters=False),
        "raw_sales": TB.BucketedTable(spark, P("raw", "raw_sales_snapshot"),
                                      [RAW.SALES_KEY], layout.n_buckets, segments=True),
        "file_audit": VersionedTable(spark, P("raw", "raw_file_audit"), {KIND: "string"}),
        "silver_stores": TB.BucketedTable(spark, P("silver", "silver_stores"),
                                          ["store_token"], layout.store_buckets, filters=False),
        "silver_sales": TB.BucketedTable(spark, P("silver", "silver_sales"), SALES_KEYS,
                                         layout.n_buckets),
        "rejected": VersionedTable(spark, P("silver", "silver_sales_rejected")),
    }


def taken_table(spark: SparkSession, layout: Layout) -> VersionedTable:
    """The record of landing files that have been taken in."""
    return VersionedTable(spark, layout.path("raw", "_landing_files"))


KINDS = {"stores": (C.STORE_COLUMNS, C.STORE_COLUMNS), "sales": (C.SALES_COLUMNS, C.SALES_COLUMNS[:3])}


def landing_pattern(layout: Layout, kind: str) -> str:
    return f"{layout.landing.rstrip('/')}/{kind}_*.csv"


def read_landing_files(spark: SparkSession, layout: Layout,
                       files: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """(stores, sales) rows of these files by kind, or of all files."""
    return tuple(read_landing(spark, landing_pattern(layout, kind) if files is None else files.get(kind, []), cols,
                              header_cols=head, multi_line=layout.multi_line)
                 for kind, (cols, head) in KINDS.items())


def audit_files(spark: SparkSession, layout: Layout, landing: DataFrame, file_type: str,
                run_ts) -> None:
    """Append audit rows for files of one kind not yet recorded."""
    file_re = C.STORES_FILE_RE if file_type == "stores" else C.SALES_FILE_RE
    rows = files_of(landing, file_type, file_re, run_ts).withColumn(KIND, F.lit(file_type))
    append_rows(spark, _tables(layout, spark)["file_audit"], rows, ["source_file"],
                newer=F.col(KIND) == file_type)


@dataclass(frozen=True)
class Done:
    """What the silver layer has completed: the run stamp it has seen, and
    the versions of raw table and rejected table at that time."""

    stamp: str = FLOOR_TS
    raw: int = 0
    rejected: int = 0

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> "Done":
        text = TB.committed(spark, path, WATERMARK)
        return cls(**json.loads(text)) if text else cls()


def _version(table: VersionedTable) -> int:
    return (table.versions() or [0])[-1]


def uncommitted(raw: TB.BucketedTable, done: Done) -> DataFrame:
    """Current versions newer than what the silver layer has completed.
    They can only stand in files that were added since."""
    rows = raw.read(keep=lambda p: raw.is_open(p) and p.since >= done.raw)
    return current_versions(rows).where(F.col("dbt_updated_at") > _ts(done.stamp)).drop(TB.BUCKET, TB.SEGMENT)


def ingest_stores(spark: SparkSession, layout: Layout, stores_land: DataFrame, run_ts) -> None:
    """Raw store snapshot + file audit + silver_stores upsert."""
    t = _tables(layout, spark)
    stores_land = materialize(spark, stores_land, "stores-landing")
    snapshot_into(spark, t["raw_stores"], RAW.stores_input(stores_land, run_ts),
                  RAW.STORES_KEY, RAW.STORES_CHECK, run_ts)
    audit_files(spark, layout, stores_land, "stores", run_ts)
    refresh_silver_stores(spark, layout, run_ts)


def refresh_silver_stores(spark: SparkSession, layout: Layout, run_ts) -> None:
    """Upsert what the raw stores have that silver has not; nothing to do
    if the raw table has not changed."""
    t = _tables(layout, spark)
    done, now = Done.of(spark, t["silver_stores"].path), _version(t["raw_stores"])
    if now > done.raw:
        upsert_into(spark, t["silver_stores"], valid_stores(uncommitted(t["raw_stores"], done)), ["store_token"])
        TB.commit(spark, t["silver_stores"].path, WATERMARK, json.dumps(asdict(Done(str(run_ts), now))))


def ingest_sales(spark: SparkSession, layout: Layout, sales_land: DataFrame, run_ts) -> None:
    """Raw sales snapshot + file audit + silver_sales upsert + rejected append."""
    t = _tables(layout, spark)
    sales_land = materialize(spark, sales_land, "sales-landing")
    snapshot_into(spark, t["raw_sales"], RAW.sales_input(sales_land, run_ts),
                  RAW.SALES_KEY, RAW.SALES_CHECK, run_ts)
    audit_files(spark, layout, sales_land, "sales", run_ts)
    refresh_silver_sales(spark, layout, run_ts)


def refresh_silver_sales(spark: SparkSession, layout: Layout, run_ts) -> None:
    """As ``refresh_silver_stores``, for the two tables fed by the raw sales.
    One record serves both: it is written when both are complete."""
    t = _tables(layout, spark)
    done, now = Done.of(spark, t["silver_sales"].path), _version(t["raw_sales"])
    if now == done.raw:
        return
    staged = materialize(spark, stage_sales(uncommitted(t["raw_sales"], done)), "staged")
    upsert_into(spark, t["silver_sales"], valid_sales(staged), SALES_KEYS)
    append_rows(spark, t["rejected"], rejected_sales(staged), REJECTED_KEYS, done.rejected,
                F.col("snapshot_updated_at") > _ts(done.stamp))
    TB.commit(spark, t["silver_sales"].path, WATERMARK,
              json.dumps(asdict(Done(str(run_ts), now, _version(t["rejected"])))))


def _states(layout: Layout, spark: SparkSession) -> dict[str, VersionedTable]:
    """Report inputs that are kept by signed deltas (``operators.maintained``)."""
    P = layout.path
    return {"by_day_store": VersionedTable(spark, P("gold", "_sales_by_day_store"), {"month": "string"}),
            "valid": VersionedTable(spark, P("gold", "_valid_by_batch")),
            "rejected": VersionedTable(spark, P("gold", "_rejected_by_batch"))}


def _day_store_rows(sales: DataFrame) -> DataFrame:
    day = F.to_date("transaction_time")
    return sales.select(F.coalesce(F.date_format(day, "yyyy-MM"), F.lit("none")).alias("month"),
                        day.alias("transaction_date"), "store_token",
                        F.coalesce(F.col("amount"), F.lit(0)).cast("decimal(38,2)").alias("store_total"),
                        F.col("amount").isNotNull().cast("long").alias("n_amount"))


def refresh_states(spark: SparkSession, layout: Layout) -> dict[str, dict]:
    """Bring the report inputs to the newest silver tables; tells what was read and written."""
    t, s = _tables(layout, spark), _states(layout, spark)
    batch = lambda df: df.select("batch_date")
    return {
        "by_day_store": refresh(s["by_day_store"], t["silver_sales"], _day_store_rows,
                                ["month", "transaction_date", "store_token"], ["store_total", "n_amount"]),
        "valid": refresh(s["valid"], t["silver_sales"], batch, ["batch_date"]),
        "rejected": refresh(s["rejected"], t["rejected"], batch, ["batch_date"]),
    }


def build_reports(spark: SparkSession, layout: Layout, run_date=None,
                  strict_batch_date: bool = True) -> dict[str, str]:
    """The per-batch audit and the three gold reports, from sums by (day,
    store) and counts by batch that are kept from run to run."""
    P = layout.path
    t = _tables(layout, spark)
    ss, audit = (_visible(t[n].read()) for n in ("silver_stores", "file_audit"))
    if audit is None or ss is None or not t["silver_sales"].exists() or not t["rejected"].exists():
        return {}
    refresh_states(spark, layout)
    state = {n: x.read() for n, x in _states(layout, spark).items()}
    ds = state["by_day_store"].withColumn("store_total", F.when(F.col("n_amount") > 0, F.col("store_total")))
    abb_path = P("silver", "silver_sales_audit_by_batch")
    TB.overwrite(spark, R.audit_from_counts(
        audit, state["valid"].withColumnRenamed("n_rows", "valid_transactions"),
        state["rejected"].withColumnRenamed("n_rows", "invalid_transactions")), abb_path)
    abb = TB.read(spark, abb_path)
    gold = {
        "rpt_transactions_by_batch": R.output1(abb, run_date, strict_batch_date),
        "rpt_sales_by_transaction_date": R.output2_of(ds, run_date),
        "rpt_top_5_stores_by_date": R.output3_of(ds, ss, run_date),
    }
    for name, df in gold.items():
        TB.overwrite(spark, df, P("gold", name))
    return {
        "raw_stores_snapshot": t["raw_stores"].path, "raw_sales_snapshot": t["raw_sales"].path,
        "raw_file_audit": t["file_audit"].path, "silver_stores": t["silver_stores"].path,
        "silver_sales": t["silver_sales"].path, "silver_sales_rejected": t["rejected"].path,
        "silver_sales_audit_by_batch": abb_path,
        **{name: P("gold", name) for name in gold},
    }


def check_tables(spark: SparkSession, tables: dict[str, str],
                 models: set[str] | None = None) -> list[dict]:
    """Run the rules (of ``models`` only, if given); one dict per rule
    (≤ 73 small rows reach the driver)."""
    rules = [r for r in SILVER_RULES + GOLD_RULES if models is None or r.model in models]
    need = {r.model for r in rules} | {r.params["to"] for r in rules if "to" in r.params}
    loaded = {n: _visible(TB.read(spark, p)) for n, p in tables.items() if n in need}
    return [r.asDict() for r in run_checks(loaded, rules).collect()]


def checks_of_versions(spark: SparkSession, tables: dict[str, str], known: dict) -> tuple[list[dict], dict]:
    """The results of all rules; those of a model whose table, and tables
    its rules refer to, have the versions that ``known`` names are taken
    from there. Returns the results and what is known now."""
    version = {n: _version(VersionedTable(spark, p)) for n, p in tables.items()}
    need: dict[str, list] = {}
    for r in SILVER_RULES + GOLD_RULES:
        need.setdefault(r.model, [version[r.model]])
        if "to" in r.params:
            need[r.model].append([r.params["to"], version[r.params["to"]]])
    stale = {m for m, v in need.items() if known.get(m, {}).get("of") != v}
    fresh = check_tables(spark, tables, stale) if stale else []
    now = {m: {"of": v, "results": [r for r in fresh if r["model"] == m] if m in stale else known[m]["results"]}
           for m, v in need.items()}
    return [r for m in need for r in now[m]["results"]], now


def _raise_on_errors(results: list[dict]) -> None:
    bad = [r for r in results if r["severity"] == "error" and r["failures"] > 0]
    if bad:
        raise CheckFailed(f"{len(bad)} data-quality rules failed: {bad}")


def _all_paths(layout: Layout) -> dict[str, str]:
    P = layout.path
    names = {"raw": ["raw_stores_snapshot", "raw_sales_snapshot", "raw_file_audit"],
             "silver": ["silver_stores", "silver_sales", "silver_sales_rejected",
                        "silver_sales_audit_by_batch"],
             "gold": ["rpt_transactions_by_batch", "rpt_sales_by_transaction_date",
                      "rpt_top_5_stores_by_date"]}
    return {n: P(layer, n) for layer, ns in names.items() for n in ns}


def _run(spark, layout, run_ts, run_date, checks, strict_batch_date, export, files=None) -> RunResult:
    if checks not in ("after_all", "after_each", "off"):
        raise ValueError(f"checks must be after_all, after_each or off, not {checks!r}")
    res = RunResult()
    each = checks == "after_each"
    paths = _all_paths(layout)

    def check_now(models: set[str]) -> None:
        if each and all(TB.exists(spark, paths[m]) for m in models):
            out = check_tables(spark, paths, models)
            res.checks += out
            _raise_on_errors(out)

    taken = taken_table(spark, layout)
    if files is None:
        files = [f for kind in KINDS for f in ingest.listing(spark, landing_pattern(layout, kind))]
    files = ingest.unseen(spark, files, taken)
    by_kind = {k: [f[0] for f in files if f[0].rsplit("/", 1)[1].startswith(f"{k}_")] for k in KINDS}
    stores_land, sales_land = read_landing_files(spark, layout, by_kind)
    t = _tables(layout, spark)
    if by_kind["stores"] or not t["raw_stores"].exists():
        ingest_stores(spark, layout, stores_land, run_ts)
    else:
        refresh_silver_stores(spark, layout, run_ts)         # what a crashed run has left
    check_now({"silver_stores"})
    if by_kind["sales"] or not t["raw_sales"].exists():
        ingest_sales(spark, layout, sales_land, run_ts)
    else:
        refresh_silver_sales(spark, layout, run_ts)
    ingest.record(spark, files, taken, run_ts)
    check_now({"silver_sales", "silver_sales_rejected"})
    return finish_run(spark, layout, res, run_date, checks, strict_batch_date, export, check_now)


def _built_from(spark: SparkSession, layout: Layout, run_date, strict_batch_date: bool) -> dict:
    """What the reports depend on: table versions, the stamp date, the option."""
    t = _tables(layout, spark)
    day = str(run_date) if run_date is not None else str(spark.range(1).select(F.current_date()).first()[0])
    return {"run_date": day, "strict": strict_batch_date,
            **{n: _version(t[n]) for n in ("file_audit", "silver_stores", "silver_sales", "rejected")}}


def finish_run(spark, layout, res, run_date=None, checks: str = "after_all", strict_batch_date: bool = True,
               export: bool = True, check_now=None) -> RunResult:
    """What follows the ingestion, of a batch run or a micro-batch:
    compaction, reports, checks, export, expiry of old versions. Reports and
    checks that were made from the same table versions stand."""
    tables = _tables(layout, spark)
    if layout.compact_above_files:
        for t in tables.values():
            if isinstance(t, TB.BucketedTable) and t.exists():
                TB.compact(t, layout.compact_above_files)
    gold = layout.path("gold", "reports")
    now, text = _built_from(spark, layout, run_date, strict_batch_date), TB.committed(spark, gold, BUILT)
    last = json.loads(text) if text else {}
    fresh = last.get("from") == now
    if fresh:
        res.tables = _all_paths(layout)
    else:
        res.tables = build_reports(spark, layout, run_date, strict_batch_date)
        last = {"from": now, "checks": last.get("checks") or {}}
    if check_now is not None:
        check_now({"silver_sales_audit_by_batch", "rpt_transactions_by_batch",
                   "rpt_sales_by_transaction_date", "rpt_top_5_stores_by_date"})
    if checks == "after_all" and res.tables:
        res.checks, known = checks_of_versions(spark, res.tables, last["checks"])
        fresh = fresh and known == last["checks"]
        last["checks"] = known
    if res.tables and not fresh:
        TB.commit(spark, gold, BUILT, json.dumps(last))
    if checks == "after_all":
        _raise_on_errors(res.checks)
    if export and layout.exports and res.tables:
        export_tables(spark, res.tables, layout.exports)
    made = [VersionedTable(spark, p) for n, p in res.tables.items() if n.startswith("rpt_") or n.endswith("_audit_by_batch")]
    for t in (*tables.values(), taken_table(spark, layout), *_states(layout, spark).values(), *made):
        t.expire(layout.keep_versions)
    return res


def register_warehouse(spark: SparkSession, layout: Layout) -> list[str]:
    """Views ``layer.table`` over the warehouse tables themselves (no copy;
    storage-only columns are hidden)."""
    return register_views(spark, {path.rstrip("/").rsplit("/", 2)[-2] + "." + name: path
                                  for name, path in _all_paths(layout).items()}, {TB.BUCKET, TB.SEGMENT, KIND})


def _visible(df: DataFrame | None) -> DataFrame | None:
    """A warehouse table without its storage-only columns."""
    return None if df is None else df.drop(TB.BUCKET, TB.SEGMENT, KIND)


__all__ = ["Layout", "RunResult", "CheckFailed", "run_daily", "snapshot_into", "upsert_into",
           "append_rows", "materialize"]
