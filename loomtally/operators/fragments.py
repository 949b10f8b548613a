"""Ordered string concatenation per key: built-in, fold and user-defined aggregate.

A key with more than `span` fragments is worked on in two levels: copies of a fragment are
counted, the fragments of `span` consecutive positions make up a segment, and the segments
are joined in order. Positions are integers, whatever the number of rows, that distinguish the
fragments of a key; equal positions fall back to the order of the texts.

A user-defined aggregate is applied before the shuffle: fragments at consecutive positions that
lie in one batch become one buffer with its first and last position, and buffers are merged in
position order. Where buffers of a key turn out to overlap, as equal positions stood in different
batches, that key alone is worked out again from its values.
"""

from __future__ import annotations

import functools
import itertools
import pickle
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from loomtally.operators.durable import durable
from loomtally.operators.skew import BLOCKS, oversized_keys, marked

SPAN = 65_536
# Texts folded one after the other before runs are merged, and levels of such merges.
RUN, FOLD_LEVELS = 64, 2

ONCE = "cast(1 AS int)"
COPIES = "_copies"

# Builds a group's result from its order column, its text column and a count expression.
Combine = Callable[[str, str, str], Column]


def _segment(pos: str, span: int) -> Column:
    return F.expr(f"(`{pos}` - pmod(`{pos}`, {int(span)})) div {int(span)}").cast("bigint")


def _listagg(order: str, value: str, copies: str) -> Column:
    text = f"`{value}`" if copies == ONCE else f"repeat(`{value}`, {copies})"
    return F.expr(f"listagg({text}, '') WITHIN GROUP (ORDER BY `{order}`, {text})")


def _items(order: str, value: str, copies: str) -> Column:
    """A group's texts in order, as an array of `(o, v, n)`."""
    return F.expr(f"array_sort(collect_list(struct(`{order}` AS o, `{value}` AS v, {copies} AS n)))")


def _joined_runs(texts: Column) -> Column:
    """Texts folded in runs of `RUN`: a buffer is copied at most that often."""
    starts = F.when(F.size(texts) > 0, F.sequence(F.lit(1), F.size(texts), F.lit(RUN)))
    return F.transform(
        starts, lambda at: F.aggregate(F.slice(texts, at, RUN), F.lit(""), lambda text, v: F.concat(text, v))
    )


def _fold(order: str, value: str, copies: str) -> Column:
    """A tree of folds, of the height that a full segment needs; any larger one still fits."""
    texts = F.transform(_items(order, value, copies), lambda item: F.repeat(item["v"], item["n"]))
    for _ in range(FOLD_LEVELS):
        texts = _joined_runs(texts)
    return F.aggregate(texts, F.lit(""), lambda text, v: F.concat(text, v))


def _count_copies(fragments: DataFrame, *columns: str) -> DataFrame:
    """Equal fragments as one row; counted map-side, so a heap of copies moves as one row."""
    return fragments.groupBy(*columns).agg(F.count("*").cast("int").alias(COPIES))


def segments(fragments: DataFrame, key: str, pos: str, value: str, span: int = SPAN) -> DataFrame:
    """`key`, `segment` and its `text`; in segment order the texts make up the whole string.

    This form has no limit on the length of the whole: a row holds `span` positions.
    """
    _check_positions(fragments, pos)
    cut = fragments.withColumn("segment", _segment(pos, span))
    counted = _count_copies(cut, key, "segment", pos, value)
    return counted.groupBy(key, "segment").agg(_listagg(pos, value, COPIES).alias("text"))


def _check_positions(fragments: DataFrame, pos: str) -> None:
    if not isinstance(fragments.schema[pos].dataType, T.IntegralType):
        raise ValueError(f"positions must be integers: {pos}")


def _combined(
    fragments: DataFrame, key: str, pos: str, value: str, span: int,
    combine: Combine, merge: Combine,
) -> DataFrame:
    """`combine` ordinary keys at once; segments of oversized ones first, then `merge`."""
    oversized = oversized_keys(fragments, F.col(key), span)
    if oversized is None:
        return fragments.groupBy(key).agg(combine(pos, value, ONCE).alias("text"))
    known = marked(fragments, F.col(key), oversized)
    ordinary = known.where(F.col(BLOCKS).isNull())
    whole = ordinary.groupBy(key).agg(combine(pos, value, ONCE).alias("text"))
    cut = known.where(F.col(BLOCKS).isNotNull()).withColumn("_segment", _segment(pos, span))
    counted = _count_copies(cut, key, "_segment", pos, value)
    parts = counted.groupBy(key, "_segment").agg(combine(pos, value, COPIES).alias("_part"))
    return whole.unionByName(
        parts.groupBy(key).agg(merge("_segment", "_part", ONCE).alias("text"))
    )


def keyed_concat(
    fragments: DataFrame, key: str, pos: str, value: str, span: int = SPAN, sort: bool = True
) -> DataFrame:
    """`key`, `text`: fragments of each key joined in position order, sorted by key."""
    _check_positions(fragments, pos)
    joined = _combined(fragments, key, pos, value, span, _listagg, _listagg)
    return joined.orderBy(key) if sort else joined


def group_fold(
    fragments: DataFrame, key: str, pos: str, value: str, span: int = SPAN
) -> DataFrame:
    """The same strings by folding each group's ordered items, about `span` at a time."""
    _check_positions(fragments, pos)
    present = fragments.where(F.col(value).isNotNull())
    return _combined(present, key, pos, value, span, _fold, _fold)


@dataclass(frozen=True)
class Aggregator:
    """A user-defined aggregate: start value, step, merge of two buffers, result.

    Buffers are any Python values that can be pickled. `merge` is associative, not necessarily
    commutative: the left buffer holds the earlier positions.
    """

    zero: Callable[[], Any]
    reduce: Callable[[Any, str], Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]


CONCAT = Aggregator(
    zero=lambda: "",
    reduce=lambda buffer, value: buffer + value,
    merge=lambda left, right: left + right,
    finish=lambda buffer: buffer,
)


def _merged(buffers: list, aggregator: Aggregator) -> Any:
    """Buffers merged in order, neighbours first, so that no buffer is copied often."""
    while len(buffers) > 1:
        merge = aggregator.merge
        buffers = [merge(*buffers[i : i + 2]) if i + 1 < len(buffers) else buffers[i] for i in range(0, len(buffers), 2)]
    return buffers[0] if buffers else aggregator.zero()


def _reduced(values: Iterable[str], aggregator: Aggregator) -> Any:
    """Values in order, each short run of them from `zero`."""
    values = iter(values)
    runs = iter(lambda: list(itertools.islice(values, RUN)), [])
    return _merged([functools.reduce(aggregator.reduce, run, aggregator.zero()) for run in runs], aggregator)


def _pickled(buffer: Any) -> bytes:
    try:
        return pickle.dumps(buffer)
    except (pickle.PicklingError, AttributeError):
        return cloudpickle.dumps(buffer)


def partial_buffers(
    fragments: DataFrame, key: str, pos: str, value: str, aggregator: Aggregator, span: int = SPAN
) -> DataFrame:
    """`key`, `_from`, `_to`, `_buffer`: runs of consecutive positions within a batch, reduced.

    A run ends where a segment of `span` positions does, so segments can be merged apart. A NULL
    position is a run of its own.
    """
    key_type = fragments.schema[key].dataType.simpleString()

    def reduce(batches):
        for batch in batches:
            places = batch["p"].cast(pa.int64())
            codes = batch["k"].dictionary_encode().indices.fill_null(-1)
            table = pa.table({"k": codes, "p": places, "v": batch["v"]})
            order = pc.sort_indices(table, [("k", "ascending"), ("p", "ascending"), ("v", "ascending")], null_placement="at_start")
            code, at = codes.take(order).to_numpy(), places.take(order)
            absent, place = at.is_null().to_numpy(zero_copy_only=False), at.fill_null(0).to_numpy()
            values = batch["v"].take(order).to_pylist()
            if not len(values):
                continue
            step = place[1:] - place[:-1]
            new = (code[1:] != code[:-1]) | (step < 0) | (step > 1) | absent[1:] | absent[:-1] | (place[1:] // span != place[:-1] // span)
            first = np.flatnonzero(np.append(True, new))
            last = np.append(first[1:], len(values))
            buffers = [_pickled(_reduced(values[a:b], aggregator)) for a, b in zip(first.tolist(), last.tolist())]
            yield pa.RecordBatch.from_arrays([
                batch["k"].take(order.take(pa.array(first))), pa.array(place[first], mask=absent[first]),
                pa.array(place[last - 1], mask=absent[first]), pa.array(buffers, pa.binary()),
            ], names=[key, "_from", "_to", "_buffer"])

    named = fragments.select(F.col(key).alias("k"), F.col(pos).alias("p"), F.col(value).alias("v"))
    return named.mapInArrow(reduce, f"`{key}` {key_type}, _from long, _to long, _buffer binary")


def _merged_groups(buffers: DataFrame, aggregator: Aggregator, *keys: str) -> DataFrame:
    """Buffers of each group merged in order: `keys`, `_buffer`, and `_clash` where they overlap."""

    @F.pandas_udf("struct<buffer binary, clash boolean>")
    def merged(groups: pd.Series) -> pd.DataFrame:
        out = []
        for group in groups:
            ends = [b["_to"] for b in group]
            follows = all(b["_from"] is not None and end is not None and b["_from"] > end for b, end in zip(group[1:], ends))
            if follows and len(group) > 1:
                out.append((_pickled(_merged([pickle.loads(b["_buffer"]) for b in group], aggregator)), False))
            else:
                out.append((group[0]["_buffer"], len(group) > 1))
        return pd.DataFrame(out, columns=["buffer", "clash"])

    ordered = F.sort_array(F.collect_list(F.struct("_from", "_to", "_buffer")))
    grouped = buffers.groupBy(*keys).agg(merged(ordered).alias("m"))
    return grouped.select(*keys, F.col("m.buffer").alias("_buffer"), F.col("m.clash").alias("_clash"))


def _over_values(
    fragments: DataFrame, key: str, pos: str, value: str, aggregator: Aggregator, span: int
) -> DataFrame:
    """`key`, `text` (a buffer) from all values of each group, in order."""

    def over_groups(whole: Callable[[Iterable], Any], read: Callable) -> Combine:
        @F.pandas_udf("binary")
        def folded(values: pd.Series, copies: pd.Series) -> pd.Series:
            return pd.Series([
                _pickled(whole(read(v) for v, n in zip(items, counts) for _ in range(n)))
                for items, counts in zip(values, copies)
            ], dtype=object)

        def combine(order: str, value: str, copies: str) -> Column:
            items = _items(order, value, copies)
            return folded(items["v"], items["n"])

        return combine

    reduce = over_groups(lambda values: _reduced(values, aggregator), lambda v: v)
    merge = over_groups(lambda buffers: _merged(list(buffers), aggregator), pickle.loads)
    return _combined(fragments, key, pos, value, span, reduce, merge)


def aggregate_with(
    fragments: DataFrame, key: str, pos: str, value: str,
    aggregator: Aggregator = CONCAT, span: int = SPAN, result: str = "string",
) -> DataFrame:
    """Apply a user-defined aggregate in position order: `key`, `text` of type `result`.

    Buffers, not values, are shuffled: `reduce` runs over the consecutive positions of a batch
    in runs that start from `zero`, `merge` combines buffers in order, and `finish` makes the
    result. NULL values are left out, and a key that has no other has no row. A NULL position
    comes before all others. Keys with more than `span` buffers are merged by segments first.
    """
    _check_positions(fragments, pos)
    present = fragments.where(F.col(value).isNotNull()).select(key, pos, value)
    buffers = durable(partial_buffers(present, key, pos, value, aggregator, span))
    oversized = oversized_keys(buffers, F.col(key), span)
    if oversized is None:
        merged = durable(_merged_groups(buffers, aggregator, key))
    else:
        known = marked(buffers, F.col(key), oversized)
        whole = _merged_groups(known.where(F.col(BLOCKS).isNull()), aggregator, key)
        # Runs that cover more positions than a segment has overlap; they are not even collected.
        covered = F.sum(F.coalesce(F.col("_to") - F.col("_from") + 1, F.lit(span + 1)))
        cut = known.where(F.col(BLOCKS).isNotNull()).withColumn("_segment", _segment("_from", span))
        cut = durable(cut.withColumn("_covered", covered.over(Window.partitionBy(key, "_segment"))).drop(BLOCKS))
        too_many = cut.where(F.col("_covered") > span).select(key).distinct()
        parts = _merged_groups(cut.where(F.col("_covered") <= span), aggregator, key, "_segment")
        overlapping = parts.where("_clash").select(key).distinct().unionByName(too_many).distinct()
        clashes = overlapping.select(key, F.lit(None).cast("binary").alias("_buffer"), F.lit(True).alias("_clash"))
        joined = parts.select(key, F.col("_segment").alias("_from"), F.col("_segment").alias("_to"), "_buffer")
        merged = durable(whole.unionByName(_merged_groups(joined, aggregator, key)).unionByName(clashes))
    clashing = merged.where("_clash").select(F.col(key).alias("_clashing"))
    done = merged.select(key, F.col("_buffer").alias("text"))
    if not clashing.isEmpty():
        met = F.col(key).eqNullSafe(F.col("_clashing"))
        again = _over_values(present.join(clashing, met, "left_semi"), key, pos, value, aggregator, span)
        done = done.join(clashing, met, "left_anti").unionByName(again)

    @F.pandas_udf(result)
    def finished(buffers: pd.Series) -> pd.Series:
        return buffers.map(lambda b: aggregator.finish(pickle.loads(b)))

    return done.select(key, finished(F.col("text")).alias("text"))
