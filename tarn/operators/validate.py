"""Primary and foreign key checks that return the violations."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarn.session import stage
from tarn.sources.writers import append_or_create

KEY_BUCKETS = 64
KEY_BATCH = "__batch"


def check_pk(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values that are missing in part or occur more than once, with their row count."""
    missing = F.lit(False)
    for c in columns:
        missing = missing | F.col(c).isNull()
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).filter(missing | (F.col("n_rows") > 1))


def check_fk(
    child: DataFrame, parent: DataFrame, columns: list[str], parent_columns: list[str] | None = None
) -> DataFrame:
    """Child keys without a parent, with their row count; keys with a NULL part are exempt.

    Children are counted per key before the join, so a hot key costs one row, not a
    skewed shuffle.
    """
    parents = parent.select(
        *[F.col(p).alias(c) for c, p in zip(columns, parent_columns or columns, strict=True)]
    ).distinct()
    keys = child.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("n_rows"))
    return keys.join(parents, columns, "left_anti")


def require_key(df: DataFrame, columns: list[str], what: str) -> None:
    """Raise when `columns` is not a key of `df`; one aggregation over the key columns."""
    bad = check_pk(df, columns).head(1)
    if bad:
        raise ValueError(f"{what}: {columns} is not a key, e.g. {bad[0].asDict()}")


def check_new_keys(df: DataFrame, columns: list[str], keys: str, batch: str) -> DataFrame:
    """Keys of a batch that may not be appended: missing in part, more than once in the batch,
    or `stored` by another batch; with their row count.

    `keys` names the table that `append_checked` keeps, bucketed by key. It is joined where it
    lies: only the keys of the batch are shuffled, once each, to its buckets.
    """
    counted = df.groupBy(*columns).agg(F.count("*").alias("n_rows"))
    return _violations(counted, columns, keys, batch)


def _violations(counted: DataFrame, columns: list[str], keys: str, batch: str) -> DataFrame:
    spark = counted.sparkSession
    detail = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", {"name": keys})
    buckets = int(detail.filter("col_name = 'Num Buckets'").select("data_type").first()[0])
    # dealt like the stored keys: Spark would rather shuffle both sides to a larger number
    counted = counted.repartition(buckets, *columns)
    others = spark.table(keys).filter(F.col(KEY_BATCH) != batch)
    known = others.select(*[F.col(f"`{c}`").alias(f"__known_{i}") for i, c in enumerate(columns)], F.lit(True).alias("__known"))
    same = reduce(and_, [F.col(f"`{c}`") == F.col(f"__known_{i}") for i, c in enumerate(columns)])
    missing = reduce(or_, [F.col(f"`{c}`").isNull() for c in columns])
    judged = counted.join(known, same, "left").withColumn("stored", F.coalesce("__known", F.lit(False)))
    return judged.filter(missing | (F.col("n_rows") > 1) | F.col("stored")).select(*columns, "n_rows", "stored")


def append_checked(
    df: DataFrame, path: str, columns: list[str], keys: str, batch: str, buckets: int = KEY_BUCKETS
) -> None:
    """Append a batch to the table at `path`, if `columns` stay a key of it.

    The keys that are there are kept in the table `keys`, bucketed and sorted by key, one
    partition per batch; the stored rows themselves are not read. A batch that would break the
    key raises, and neither table changes. Keys are written before rows, both replace what an
    earlier try of the same batch left, so a batch stopped anywhere may be repeated, also with
    other rows. `df` has to give the same rows each time it is read. One batch at a time is
    to be appended. Choose `buckets` for the table it will become: some 10 million keys each.
    """
    spark = df.sparkSession
    counted = stage(df.groupBy(*columns).agg(F.count("*").alias("n_rows")), "batch-keys")
    mine = counted.select(*columns, F.lit(batch).alias(KEY_BATCH))
    if not spark.catalog.tableExists(keys):
        empty = mine.limit(0).write.partitionBy(KEY_BATCH).bucketBy(buckets, *columns).sortBy(*columns)
        empty.format("parquet").saveAsTable(keys)
    bad = _violations(counted, columns, keys, batch).head(1)
    if bad:
        raise ValueError(f"batch {batch}: {columns} would be no key, e.g. {bad[0].asDict()}")
    fresh = counted.select(*columns).repartition(buckets, *columns)
    name, value = (x.replace("\\", "\\\\").replace("'", "\\'") for x in (keys, batch))
    # a partition that is named is the only one overwritten, whatever the session's mode
    spark.sql(f"INSERT OVERWRITE IDENTIFIER('{name}') PARTITION ({KEY_BATCH} = '{value}') SELECT * FROM {{fresh}}", fresh=fresh)
    spark.catalog.refreshTable(keys)
    append_or_create(df, path, batch)
