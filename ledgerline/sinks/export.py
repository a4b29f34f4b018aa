"""Parquet export of the raw, silver and gold tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.sinks import tables as TB

# --- fixed values: exported tables per layer (the file audit is not exported) ---
EXPORT_TABLES: dict[str, list[str]] = {
    "raw": ["raw_stores_snapshot", "raw_sales_snapshot"],
    "silver": ["silver_stores", "silver_sales", "silver_sales_rejected",
               "silver_sales_audit_by_batch"],
    "gold": ["rpt_transactions_by_batch", "rpt_sales_by_transaction_date",
             "rpt_top_5_stores_by_date"],
}
MANIFEST = "_manifest.json"


def target_of(root: str, layer: str, table: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{table}.parquet"


def export_parquet(spark: SparkSession, tables: dict[str, DataFrame], root: str) -> list[str]:
    """Write each available table to ``root/<layer>/<table>.parquet`` (zstd).

    Each table is written to a ``.tmp`` sibling and then swapped in with
    file-system renames, so a reader never sees a half-written table.
    Tables missing from ``tables`` are skipped. Returns the written paths.
    """
    written = []
    for layer, names in EXPORT_TABLES.items():
        for t in names:
            if t in tables:
                target = target_of(root, layer, t)
                _swap(spark, tables[t], target)
                written.append(target)
    return written


def _swap(spark: SparkSession, df: DataFrame, target: str) -> None:
    tmp, old = target + ".tmp", target + ".old"
    df.write.mode("overwrite").option("compression", "zstd").parquet(tmp)
    fs, p = TB._fs(spark, target)
    if fs.exists(p):
        fs.delete(TB._fs(spark, old)[1], True)
        TB.rename(spark, target, old)
    TB.rename(spark, tmp, target)
    fs.delete(TB._fs(spark, old)[1], True)


def export_tables(spark: SparkSession, tables: dict[str, str], root: str) -> dict[str, list[int] | None]:
    """Export the warehouse tables at these paths, all nine of them. A
    manifest in the export tells what it was made from: a table of the same
    version is left alone; of a bucketed one only the buckets whose files
    have changed are written (the export keeps the bucket folders); others
    are swapped in whole. Returns the written buckets of each table (None:
    all of it)."""
    out: dict[str, list[int] | None] = {}
    for layer, names in EXPORT_TABLES.items():
        for t in names:
            if t not in tables:
                continue
            table, target = TB.table_at(spark, tables[t]), target_of(root, layer, t)
            m = table.manifest()
            text = TB._read_text(spark, f"{target}/{MANIFEST}") if TB.exists(spark, target) else None
            was = json.loads(text) if text else {}
            now: dict = {"version": m.version}
            if was.get("version") == m.version:
                out[t] = []
                continue
            df = table.read(m)
            if TB.BUCKET not in df.columns:
                _swap(spark, df, target)
                out[t] = None
            else:
                now["buckets"] = buckets = {}
                for p in m.parts:
                    buckets.setdefault(table.value(p, TB.BUCKET), []).extend([p.run, *p.files])
                old = was.get("buckets", {})
                changed = sorted(int(b) for b in buckets if buckets[b] != old.get(b))
                if changed or not was:
                    df = table.read(m, keep=lambda p: int(table.value(p, TB.BUCKET)) in changed) if was else df
                    df = df.drop(TB.SEGMENT)
                    TB.remember_schema(df, target)
                    if len({p.run for p in m.parts}) > 1:     # rows of one run are gathered by bucket already
                        df = df.hint("rebalance", F.col(TB.BUCKET))
                    (df.write.mode("overwrite").option("compression", "zstd")
                     .option("partitionOverwriteMode", "dynamic").partitionBy(TB.BUCKET).parquet(target))
                out[t] = changed
            TB._write_text(spark, f"{target}/{MANIFEST}", json.dumps(now))
    return out
