"""Row order within a key of any size: numbers, neighbours and running maxima over time buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BUCKET_MS = 3_600_000
#: Rows that a fold hands back at once.
BATCH = 5000


def time_bucket(time_ms: Column | str, bucket_ms: int = BUCKET_MS) -> Column:
    return F.floor((F.col(time_ms) if isinstance(time_ms, str) else time_ms) / bucket_ms)


def ordered(
    df: DataFrame,
    key: list[str],
    bucket: Column,
    order: list[str],
    *,
    number: str | None = None,
    lag: dict[str, Column] | None = None,
    lead: dict[str, Column] | None = None,
    running_max: dict[str, Column] | None = None,
) -> DataFrame:
    """``df`` with columns that depend on the order of the rows of each key.

    ``number`` counts from 0; ``lag`` and ``lead`` give a value of the row before and behind,
    null at the ends; ``running_max`` gives the greatest value of all earlier rows, null for the
    first. ``order`` must name columns that tell rows apart, ascending, nulls first, and
    ``bucket`` must not fall in that order. Nulls in a key form a group.

    A plain window would put all rows of a key into one task. Here windows run within a
    bucket of a key; one row per bucket carries counts, edges and maxima across buckets.
    """
    lag, lead, running_max = lag or {}, lead or {}, running_max or {}
    work = df.withColumn("__b", bucket)
    group = [*key, "__b"]
    local = Window.partitionBy(*group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order)
    rows = work.withColumn("__n", F.row_number().over(local)).withColumn("__c", F.count("*").over(Window.partitionBy(*group)))
    rows = rows.withColumns({f"__lag_{o}": F.lag(v).over(local) for o, v in lag.items()})
    rows = rows.withColumns({f"__lead_{o}": F.lead(v).over(local) for o, v in lead.items()})
    rows = rows.withColumns({f"__max_{o}": F.max(v).over(before) for o, v in running_max.items()})
    edges = work.groupBy(*group).agg(
        F.count("*").alias("__k"),
        *[F.max_by(F.struct(v.alias("v")), place).alias(f"__last_{o}") for o, v in lag.items()],
        *[F.min_by(F.struct(v.alias("v")), place).alias(f"__first_{o}") for o, v in lead.items()],
        *[F.max(v).alias(f"__most_{o}") for o, v in running_max.items()],
    )
    across = Window.partitionBy(*key).orderBy(F.col("__b").asc_nulls_first())
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *[F.col(c).alias(f"__key_{c}") for c in group],
        F.coalesce(F.sum("__k").over(earlier), F.lit(0)).alias("__before"),
        *[F.lag(f"__last_{o}").over(across)["v"].alias(f"__from_{o}") for o in lag],
        *[F.lead(f"__first_{o}").over(across)["v"].alias(f"__to_{o}") for o in lead],
        *[F.max(f"__most_{o}").over(earlier).alias(f"__carry_{o}") for o in running_max],
    )
    same = F.lit(True)
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"__key_{c}"))
    joined = rows.join(carried, same)
    out = {o: F.when(F.col("__n") == 1, F.col(f"__from_{o}")).otherwise(F.col(f"__lag_{o}")) for o in lag}
    out |= {o: F.when(F.col("__n") == F.col("__c"), F.col(f"__to_{o}")).otherwise(F.col(f"__lead_{o}")) for o in lead}
    out |= {o: F.greatest(F.col(f"__max_{o}"), F.col(f"__carry_{o}")) for o in running_max}
    if number:
        out[number] = F.col("__before") + F.col("__n") - 1
    return joined.select(*[F.col(c) for c in df.columns if c not in out], *[v.alias(o) for o, v in out.items()])


def fold_sorted(df: DataFrame, key: list[str], order: list[str], fold: Callable[[tuple, Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows made by ``fold(key values, rows of the key in order)``; the rows come one by one.

    For folds that no window can express. A key's rows are never collected: they stream
    through a task in batches, sorted by Spark, which spills where it must.
    """
    names = [f.split()[0].strip("`") for f in schema.split(",")]
    columns = df.columns
    at = [columns.index(k) for k in key]
    shape = to_arrow_schema(T._parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        row = next(source, None)
        out: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], type=shape.field(i).type) for i in range(len(names))], names=names)

        while row is not None:
            this = tuple(row[i] for i in at)
            after: list[tuple | None] = [None]

            def group(first: tuple = row, this: tuple = this, after: list = after) -> Iterator[tuple]:
                yield first
                for r in source:
                    if tuple(r[i] for i in at) != this:
                        after[0] = r
                        return
                    yield r

            rest = group()
            for one in fold(this, rest):
                out.append(one)
                if len(out) >= BATCH:
                    yield made()
                    out = []
            for _ in rest:
                pass
            row = after[0]
        if out:
            yield made()

    return df.repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(run, schema)
