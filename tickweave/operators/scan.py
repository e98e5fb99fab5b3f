"""Ordered recurrences per key as a blocked prefix scan.

The cross-window RSI state follows ``x[k] = a[k] * x[k-1] + b[k]`` per key.
Affine maps compose associatively, so the recurrence is a prefix scan.  Each
key's elements are cut into blocks of at most ``block`` consecutive elements,
which are folded side by side: one pass over a block in order, from zero,
which leaves at every element the map of the block up to it.  The maps of
whole blocks are again an ordered sequence per key, one ``block``-th as long,
and are scanned the same way, one level up, until every key has one block.
Each element's value is then its in-block map applied to the value at the end
of the previous block.

Maps are kept as numbers with a wide exponent, a double near one and a count
of factors ``2^512``; the columns ``b`` of a row share theirs.  Products of
thousands of factors neither overflow nor lose the ratio of the columns, and
results don't depend on the block size beyond the rounding of single steps.

The fold is the one step that the built-in functions can't express without
copying a growing array per element; it runs over Arrow batches of
per-window summaries, never over quotes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tickweave.session import cut_lineage

RANK = "_rank"
BLOCK = "_block"
DEFAULT_BLOCK = 4096
# One step of the exponent, and the size from which a number is brought back
# towards one: the product of two numbers below it is far from overflow.
_STEP, _LARGE = 2.0 ** 512, 2.0 ** 256


def _scaled(x: Column, steps: Column) -> Column:
    """``x * 2^(-512 * steps)``; zero from the third step down, where it no
    longer counts beside the number that it is added to."""
    return (F.when(steps == 0, x).when(steps == 1, x / _STEP).when(steps == 2, x / _STEP / _STEP)
            .when(steps == -1, x * _STEP).when(steps > 2, F.lit(0.0)).otherwise(x * _STEP * _STEP))


def _largest(cols: Sequence[str]) -> Column:
    return F.greatest(F.lit(0.0), *[F.abs(c) for c in cols])


def _fold_blocks(df: DataFrame, key: str, bcols: Sequence[str]) -> DataFrame:
    """Replace each row's map (``_a``, ``_ae``, ``bcols``, ``_be``) by the
    composition of the maps of its (key, BLOCK) up to it in the order of RANK."""
    names, n, step, large = ["_a", "_ae", *bcols, "_be"], len(bcols), _STEP, _LARGE
    schema = T.StructType([f for f in df.schema.fields])

    # Defined in here so that workers get it by value and need no installed package.
    def run(batches):
        import pyarrow as pa

        last, a, ae, bs, be = None, 1.0, 0, [0.0] * n, 0
        small = 1 / large
        for batch in batches:
            keys = batch.column(key).to_pylist()
            blocks = batch.column("_block").to_pylist()
            cols = [batch.column(c).to_pylist() for c in names]
            for i, (k, blk, xa, xe, *xb, xbe) in enumerate(zip(keys, blocks, *cols)):
                if (k, blk) != last:
                    last, a, ae, bs, be = (k, blk), xa, xe, xb, xbe
                else:
                    # Sum of the moved old value and the new one, at the larger exponent.
                    old, moved = [xa * b for b in bs], xe + be
                    if not any(xb):
                        bs, be = old, moved
                    elif not any(old):
                        bs, be = xb, xbe
                    elif moved == xbe:
                        bs = [x + y for x, y in zip(old, xb)]
                    elif moved > xbe:
                        f = step ** (xbe - moved) if moved - xbe <= 2 else 0.0
                        bs, be = [x + y * f for x, y in zip(old, xb)], moved
                    else:
                        f = step ** (moved - xbe) if xbe - moved <= 2 else 0.0
                        bs, be = [x * f + y for x, y in zip(old, xb)], xbe
                    a, ae = a * xa, ae + xe
                if not small <= a < large and a:
                    up = 1 if abs(a) >= large else -1 if abs(a) < small else 0
                    a, ae = a * step ** -up, ae + up
                top = max(map(abs, bs))
                if not small <= top < large and top:
                    up = 1 if top >= large else -1
                    bs, be = [b * step ** -up for b in bs], be + up
                for c, v in zip(cols, (a, ae, *bs, be)):
                    c[i] = v
            done = dict(zip(names, cols))
            yield pa.RecordBatch.from_arrays(
                [pa.array(done[f.name], f.type) if f.name in done else batch.column(f.name) for f in batch.schema], schema=batch.schema)

    dealt = df.repartition(key, BLOCK).sortWithinPartitions(key, BLOCK, RANK)
    return dealt.mapInArrow(run, schema)


def _scan(df: DataFrame, keep: Sequence[str], key: str, bcols: Sequence[str], longest: int, block: int) -> DataFrame:
    """Inclusive compositions over the dense RANK (0, 1, ...) of each key."""
    maps = ["_a", "_ae", *bcols, "_be"]
    inner = _fold_blocks(df.withColumn(BLOCK, F.floor(F.col(RANK) / block).cast("long")), key, bcols)
    if longest <= block:
        return inner.select(*keep, *maps)
    # Several blocks per key: scan the blocks' own maps, one level up, and
    # apply each element's map to the value at the end of the block before.
    inner = cut_lineage(inner)
    ends = inner.groupBy(key, BLOCK).agg(F.max_by(F.struct(*maps), RANK).alias("_m"))
    before = _scan(ends.select(key, F.col(BLOCK).alias(RANK), "_m.*"), [key, RANK], key, bcols, -(-longest // block), block)
    before = before.select(key, (F.col(RANK) + 1).alias(BLOCK), F.col("_a").alias("_pa"), F.col("_ae").alias("_pae"),
                           *[F.col(c).alias(f"_p{c}") for c in bcols], F.col("_be").alias("_pbe"))
    joined = inner.join(before, [key, BLOCK], "left").withColumn("_moved", F.col("_ae") + F.col("_pbe"))
    some = _largest(bcols) > 0
    past = F.col("_pa").isNotNull() & (F.col("_a") != 0) & (_largest([f"_p{c}" for c in bcols]) > 0)
    top = F.when(some & past, F.greatest("_be", "_moved")).when(past, F.col("_moved")).otherwise(F.col("_be"))

    def total(c: str) -> Column:
        left = F.when(past, _scaled(F.col("_a") * F.col(f"_p{c}"), F.col("_top") - F.col("_moved"))).otherwise(0.0)
        return left + F.when(some, _scaled(F.col(c), F.col("_top") - F.col("_be"))).otherwise(0.0)

    has = F.col("_pa").isNotNull()
    return joined.withColumn("_top", top).select(
        *keep, F.when(has, F.col("_a") * F.col("_pa")).otherwise(F.col("_a")).alias("_a"),
        F.when(has, F.col("_ae") + F.col("_pae")).otherwise(F.col("_ae")).alias("_ae"),
        *[total(c).alias(c) for c in bcols], F.col("_top").alias("_be"))


def affine_scan(df: DataFrame, key: str, order: Sequence[str], a: str, bs: Sequence[str],
                out: Sequence[str] | None = None, block: int = DEFAULT_BLOCK,
                max_len: int | None = None, exponent: str | None = None) -> DataFrame:
    """For each key in ``order`` (unique per key): ``x_j[k] = a[k] * x_j[k-1] + b_j[k]``
    with ``x_j[0] = 0`` for every column ``b_j`` in ``bs``.

    Returns ``df`` with the scanned values (doubles) in columns ``out``
    (default: the names in ``bs``, replaced).  With ``exponent`` the values
    are mantissas and that column counts the common factors ``2^512`` of a
    row: their ratio stays exact where the values leave the range of a double.
    ``max_len`` is an upper bound of the rows per key; without it one
    aggregate counts them.
    """
    block = max(2, block)
    out = list(out or bs)
    bcols = [f"_b{j}" for j in range(len(bs))]
    carry = [f.name for f in df.schema.fields if f.name not in out and f.name != key]
    # The rank is the only per-key ordered pass; it runs over per-window
    # summaries (one row per key and window), not over quotes.
    ranked = df.select(key, (F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1).cast("long").alias(RANK),
                       *[F.col(c).alias(f"_row_{i}") for i, c in enumerate(carry)],
                       F.col(a).cast("double").alias("_a"), F.lit(0).alias("_ae"),
                       *[F.col(b).cast("double").alias(c) for b, c in zip(bs, bcols)], F.lit(0).alias("_be"))
    longest = max_len if max_len is not None else (df.groupBy(key).count().agg(F.max("count")).first()[0] or 0)
    keep = [key, RANK, *[f"_row_{i}" for i in range(len(carry))]]
    done = _scan(ranked, keep, key, bcols, longest, block)
    names = [F.col(f"_row_{i}").alias(c) for i, c in enumerate(carry)]
    if exponent:
        return done.select(key, *names, *[F.col(c).alias(o) for c, o in zip(bcols, out)], F.col("_be").alias(exponent))
    return done.select(key, *names, *[plain_value(c, "_be").alias(o) for c, o in zip(bcols, out)])


def plain_value(mantissa: str, exponent: str) -> Column:
    """The double of a scanned value, infinite beyond the range of doubles."""
    x, e = F.col(mantissa), F.col(exponent)
    far = F.when(e > 2, x * float("inf")).when(e < -2, F.lit(0.0)).otherwise(_scaled(x, -e))
    return F.when(x == 0, 0.0).otherwise(far)
