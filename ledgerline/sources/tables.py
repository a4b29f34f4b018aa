"""Parquet tables: reading, existence checks, and views ``layer.table``."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType, StringType

from ledgerline.sinks import tables as TB
from ledgerline.sinks.versions import RUN


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    return TB.exists(spark, path)


def register_views(spark: SparkSession, paths: Mapping[str, str], hidden: Collection[str] = ()) -> list[str]:
    """A view ``layer.table`` (and a temp view ``layer_table``) for each
    table at a path; tables without a first write are skipped, ``hidden``
    columns are not shown.

    A view of the catalog can't hold a frame. It stands on an external table
    (``layer._table``) with the stored schema, so rows that are older than a
    column give NULL for it, whose partitions are the parts of the table's
    newest version, or the partition folders of a plain folder. Call again
    after a run to see its version."""
    from ledgerline.session import work_dir

    have = {d.name for d in spark.catalog.listDatabases()}
    names = []
    for name, path in paths.items():
        df = TB.read(spark, path)
        if df is None:
            continue
        layer, table = name.split(".")
        if layer not in have:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{work_dir(spark, layer)}'")
            have.add(layer)
        shown = [c for c in df.columns if c not in hidden]
        df.select(*shown).createOrReplaceTempView(f"{layer}_{table}")
        schema, levels, parts = _parts(spark, path, df)
        spark.sql(f"DROP TABLE IF EXISTS {layer}._{table}")
        typed = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f"PARTITIONED BY ({', '.join(levels)})" if levels else ""
        spark.sql(f"CREATE TABLE {layer}._{table} ({typed}) USING parquet {by} LOCATION '{path}'")
        if parts:
            spark.sql(f"ALTER TABLE {layer}._{table} ADD " + " ".join(
                f"PARTITION ({', '.join(f'{k}={v!r}' for k, v in values.items())}) LOCATION '{folder}'"
                for values, folder in parts))
        cols = ", ".join(f"`{c}`" for c in shown)
        spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS SELECT {cols} FROM {layer}._{table}")
        names.append(name)
    return names


def _parts(spark: SparkSession, path: str, df: DataFrame) -> tuple[StructType, list[str], list[tuple[dict, str]]]:
    """Schema with partition columns, their names, and (values, folder) of each partition."""
    t = TB.table_at(spark, path)
    if t is not None:
        m = t.manifest()
        levels = [RUN, *t.levels]
        run = StructField(RUN, StringType())
        return (StructType([*df.schema.fields, run]), levels,
                [(dict(zip(levels, (p.run, *p.values))), t._folder(p)) for p in m.parts])
    folders = sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()})
    found = [(dict(x.split("=", 1) for x in f.split("/") if "=" in x), f) for f in folders]
    levels = list(found[0][0]) if found else []
    return df.schema, levels, found if levels else []


def register_exports(spark: SparkSession, root: str,
                     layout: dict[str, list[str]] | None = None) -> list[str]:
    """A view ``layer.table`` (and a temp view ``layer_table``) per exported
    table found under ``root/<layer>/<table>.parquet``; missing tables are
    skipped. Call again after a new export to pick up new files."""
    from ledgerline.sinks.export import EXPORT_TABLES, target_of

    return register_views(spark, {f"{layer}.{t}": target_of(root, layer, t)
                                  for layer, tables in (layout or EXPORT_TABLES).items() for t in tables}, {TB.BUCKET})
