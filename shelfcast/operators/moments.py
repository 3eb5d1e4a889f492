"""Mergeable centred moments per key: count, means and co-moments about the means.

States of parts of a key merge into the state of the whole, and states of keys into those
of a coarser key, without ever forming a raw sum of squares, so a variance keeps its digits
at any number of rows. Rows are condensed in the task that reads them before they are
shuffled: a key with a third of all rows sends one state per batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows of a key in a batch from which on their state is smaller than they are.
CONDENSE_FROM = 8
# Rows whose products a task holds at a time.
ROWS_AT_ONCE = 20_000

STATE = ["part", "n", "means", "comoments"]


def pairs(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of each entry of a stored upper half."""
    return np.triu_indices(size)


def row_states(rows: DataFrame, keys: Sequence[str], values: Sequence[Column], n: Column | None = None) -> DataFrame:
    """A state for each row: ``keys``, ``part``, ``n``, ``means`` and null ``comoments``.

    ``n`` says how often a row counts. Rows with a null value or count take no part.
    """
    count = F.lit(1.0) if n is None else n.cast("double")
    states = rows.select(
        *keys,
        "part",
        count.alias("n"),
        F.array(*[v.cast("double") for v in values]).alias("means"),
        F.lit(None).cast("array<double>").alias("comoments"),
    )
    return states.where((F.col("n") > 0) & ~F.exists("means", lambda v: v.isNull()))


def matrix_of(lists: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as rows; zeros for a null list."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    out = np.zeros((len(lists), width))
    present = lists.is_valid().to_numpy(zero_copy_only=False)
    out[present] = lists.drop_null().flatten().to_numpy().reshape(-1, width)
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """Parts of a batch, every field nullable so that all parts have one schema."""
    fields = pa.schema([pa.field(f.name, f.type) for f in batch.schema])
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        yield pa.Table.from_arrays([pa.chunked_array([c]) for c in part.columns], schema=fields)


def lists_of(rows: np.ndarray) -> pa.Array:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.reshape(-1)))


def merged(table: pa.Table, columns: Sequence[str], size: int) -> pa.Table:
    """One state per run of equal ``columns`` in a table that is sorted by them."""
    starts = run_starts(table, columns)
    if len(starts) == table.num_rows:
        return table
    sizes = np.diff([*starts, table.num_rows])
    several = sizes > 1
    # a state by itself stays as it is: that of a single row has no co-moments to carry
    alone = table.take(pa.array(starts[~several]))
    table = table.take(pa.array(np.nonzero(np.repeat(several, sizes))[0]))
    heads = np.cumsum(sizes[several]) - sizes[several]
    segment = np.repeat(np.arange(len(heads)), sizes[several])
    n = table["n"].to_numpy()
    means = matrix_of(table["means"], size)
    i, j = pairs(size)
    total = np.add.reduceat(n, heads)
    mean = np.add.reduceat(means * n[:, None], heads) / total[:, None]
    off = means - mean[segment]
    spread = matrix_of(table["comoments"], len(i))
    spread += n[:, None] * off[:, i] * off[:, j]
    first = table.take(pa.array(heads))
    new = {"n": pa.array(total), "means": lists_of(mean), "comoments": lists_of(np.add.reduceat(spread, heads))}
    made = pa.table({c: new.get(c, first[c]) for c in table.column_names}).cast(table.schema)
    order = np.argsort(np.concatenate([starts[~several], starts[several]]), kind="stable")
    return pa.concat_tables([alone, made]).combine_chunks().take(pa.array(order))


def run_starts(table: pa.Table, columns: Sequence[str]) -> np.ndarray:
    """Where a run of equal values begins; null equals null."""
    change = np.ones(table.num_rows, bool)
    if table.num_rows:
        change[1:] = False
    for c in columns:
        values = table[c].to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    return np.nonzero(change)[0]


def _flat_names(size: int) -> list[str]:
    return [f"_mean{k}" for k in range(size)]


def _flat(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
    """The batch with a plain column for each mean."""
    means = matrix_of(batch["means"], size)
    columns = {}
    for name in batch.schema.names:
        columns |= dict(zip(_flat_names(size), map(pa.array, means.T.copy()))) if name == "means" else {name: batch[name]}
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _listed(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
    """The batch with its means as lists again."""
    names = _flat_names(size)
    columns = {}
    for name in batch.schema.names:
        if name == names[0]:
            columns["means"] = lists_of(np.column_stack([batch[m].to_numpy(zero_copy_only=False) for m in names]))
        elif name not in names:
            columns[name] = batch[name]
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def condensed(table: pa.Table, columns: Sequence[str], size: int) -> list[pa.RecordBatch]:
    """States of ``table`` with those of frequent keys merged."""
    return [part for batch in table.combine_chunks().to_batches() for part in _condense(columns, size)(iter([batch]))]


def _condense(columns: Sequence[str], size: int):
    """Merge the rows of frequent keys within slices of every batch; pass the others on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for table in _slices(batch):
                number = np.zeros(table.num_rows, np.int64)
                for c in columns:
                    codes = pc.dictionary_encode(table[c].combine_chunks(), null_encoding="encode")
                    number = number * len(codes.dictionary) + codes.indices.to_numpy()
                    # keep the numbers below the square of the row count
                    number = np.unique(number, return_inverse=True)[1]
                often = np.bincount(number)[number] >= CONDENSE_FROM
                rare = np.nonzero(~often)[0]
                yield from table.take(pa.array(rare)).to_batches()
                frequent = np.nonzero(often)[0]
                if len(frequent):
                    order = frequent[np.argsort(number[frequent], kind="stable")]
                    yield from merged(table.take(pa.array(order)), columns, size).to_batches()

    return run


class _Level:
    """Merges a sorted stream of states to one per key and part, holding one key's only."""

    def __init__(self, keys: Sequence[str], size: int):
        self.keys, self.size, self.held = list(keys), size, None

    def feed(self, table: pa.Table) -> pa.Table:
        table = table.select([*self.keys, *STATE])
        if self.held is not None:
            table = pa.concat_tables([self.held, table])
        table = self._own(table)
        last = int(run_starts(table, self.keys)[-1])
        self.held = table.slice(last).combine_chunks()
        return table.slice(0, last)

    def finish(self) -> pa.Table | None:
        return self.held

    def _own(self, table):
        # parts of a coarser key come in turns: order them within the runs of the key
        starts = run_starts(table, self.keys)
        run = np.repeat(np.arange(len(starts)), np.diff([*starts, table.num_rows]))
        part = pc.dictionary_encode(table["part"].combine_chunks()).indices.to_numpy()
        table = table.take(pa.array(np.lexsort((part, run))))
        return merged(table, [*self.keys, "part"], self.size)


def merged_states(
    states: DataFrame,
    levels: Sequence[Sequence[str]],
    size: int,
    made: Callable[[int, pa.Table], Iterator[pa.Table]] | None = None,
    fields: Sequence[T.StructField] = (),
) -> DataFrame:
    """States per key of every level: ``level``, all key columns, ``part``, ``n``, ``means``,
    ``comoments``.

    With ``made`` the rows of a level are those that it makes of a table of states, which
    holds whole keys; they may have ``fields`` besides. What a row lacks is null.

    ``levels`` run from fine to coarse and each holds the columns of the next, so one
    exchange, on the coarsest key, serves all; key columns that a level lacks are null.
    Rows are condensed before the exchange. After it a task reads its keys in order and
    holds one key at a time.
    """
    finest, coarsest = list(levels[0]), list(levels[-1])
    for fine, coarse in zip(levels, levels[1:]):
        if not set(coarse) <= set(fine):
            raise ValueError(f"{coarse} is no roll-up of {fine}")
    # plain columns reach Python many times faster than lists
    flat = states.select(
        *finest, "part", "n", *[F.col("means")[k].alias(name) for k, name in enumerate(_flat_names(size))], "comoments"
    )
    condense = _condense([*finest, "part"], size)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in condense(_listed(batch, size) for batch in batches):
            yield _flat(batch, size)

    condensed = flat.mapInArrow(first, flat.schema)
    order = [k for level in reversed(levels) for k in level]
    order = list(dict.fromkeys(order))
    dealt = condensed.repartition(*coarsest).sortWithinPartitions(*order, "part")
    own = [T.StructField(c, states.schema[c].dataType) for c in [*finest, *STATE]]
    schema = T.StructType([T.StructField("level", T.IntegerType()), *own, *fields])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chain = [_Level(keys, size) for keys in levels]

        def emit(number: int, table: pa.Table) -> Iterator[pa.RecordBatch]:
            for rows in made(number, table) if made else [table]:
                if "level" not in rows.column_names:
                    rows = rows.append_column("level", pa.array([number] * rows.num_rows, pa.int32()))
                filled = [rows[f.name] if f.name in rows.column_names else pa.nulls(rows.num_rows, f.type) for f in arrow]
                yield from pa.table(filled, names=arrow.names).cast(arrow).combine_chunks().to_batches()

        def climb(number: int, table: pa.Table | None) -> Iterator[pa.RecordBatch]:
            if table is None or not table.num_rows or number == len(chain):
                return
            done = chain[number].feed(table)
            if done.num_rows:
                yield from emit(number, done)
                yield from climb(number + 1, done)

        for batch in batches:
            for table in _slices(_listed(batch, size)):
                yield from climb(0, table)
        for number, level in enumerate(chain):
            last = level.finish()
            if last is not None:
                yield from emit(number, last)
                yield from climb(number + 1, last)

    return dealt.mapInArrow(run, schema)
