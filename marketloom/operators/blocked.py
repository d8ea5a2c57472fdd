"""Products of purchases and co-occurrence counts, customer by customer, over a compressed adjacency that tasks map."""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from ..store import Store, shared_store, uri
from .ranking import placed

#: Customers of one task, at most about.
BLOCK = 32_768
#: Neighbours of one adjacency row, of which a product with more has several.
NEIGHBOURS = 4096
#: Counts up to which a neighbour is written as often as it counts.
REPEATED = 4
#: Neighbours of a customer's products that are summed at once.
WAITING = 4_000_000
#: Sums that are brought in the order of the products together.
SORTED = 4_000_000
#: Customers whose adjacency rows are looked up together.
TOGETHER = 200
#: Edges that a task holds before it writes them as one file.
GATHER = 4_000_000


def numbered(df: DataFrame, key: str) -> DataFrame:
    """``df`` with ``number``, 0-based in the order of its unique ``key``; written once."""
    return cut(placed(df, [], [F.col(key)], "number").withColumn("number", (F.col("number") - 1).cast("int")))


@dataclass
class Adjacency:
    """The neighbours of each product, in files that workers map; no task holds them."""

    store: Store
    files: list[str]
    products: int
    opened: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"store": self.store, "files": self.files, "products": self.products, "opened": {}}

    def array(self, name: str) -> np.ndarray:
        if name not in self.opened:
            # A plain array over the map: taking a piece of it is cheaper.
            self.opened[name] = np.asarray(self.store.read(name))
        return self.opened[name]

    def rows(self, products: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray | None]]]:
        """(how many rows each of the products has, (product, neighbours, counts or None for ones) of each row)."""
        if not self.files or not len(products):
            return np.zeros(len(products), np.int64), []
        first = self.array("first")
        many = first[products + 1] - first[products]
        at = np.repeat(first[products] - np.cumsum(many) + many, many) + np.arange(many.sum())
        found = [self.array(c)[at] for c in ("file", "start", "counts", "length")]
        near = {i: self.array(f"to-{self.files[i]}") for i in np.unique(found[0]).tolist()}
        out = []
        for product, file, start, counts, length in zip(np.repeat(products, many).tolist(), *(f.tolist() for f in found)):
            n = None if counts < 0 else self.array(f"n-{self.files[file]}")[counts: counts + length]
            out.append((product, near[file][start: start + length], n))
        return many, out


def by_number(table: str, columns: list[str]) -> dict[str, pa.ChunkedArray]:
    """Columns of a table that ``numbered`` wrote, in the order of the numbers, which have no gaps."""
    store, path = pyarrow.fs.FileSystem.from_uri(table)
    all_ = pq.read_table(path, columns=["number", *columns], filesystem=store).sort_by("number")
    return {c: all_.column(c) for c in columns}


def adjacency(edges: DataFrame, products: int, table: str) -> Adjacency:
    """Writes the neighbours of each product, by product number, to the shared folder.

    ``edges`` holds (product_a, product_b, n), ``table`` is where ``numbered`` wrote the products. Edges are shuffled once, by their
    first product; a task looks up both numbers (an id that comes twice has two), sorts what it gets and writes files ``to-i`` (neighbours, as often as they count up to REPEATED, else once) and ``n-i`` (what
    each entry counts, of rows in which one is not 1). The rows are
    found by ``first`` (by product), ``file``, ``start``, ``counts`` (where the counts start, or -1) and ``length``. A file has
    a name that no other attempt has, and only the rows of finished tasks name files, so a task that runs twice does no harm.
    """
    store = shared_store(edges.sparkSession, "adjacency")
    most, gather = NEIGHBOURS, GATHER
    def found(ids: pa.Array, a: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.flatnonzero(np.concatenate(([True], pc.not_equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False))))
        copies, distinct = np.diff(first, append=len(ids)), ids.take(pa.array(first))
        n, at = a.column("n").to_numpy(), []
        for c in ("product_a", "product_b"):
            at.append(pc.fill_null(pc.index_in(a.column(c), value_set=distinct), -1).to_numpy())
        known = (at[0] >= 0) & (at[1] >= 0)
        at, n = [x[known] for x in at], n[known]
        # Each pair of numbers that the two ids have.
        times = copies[at[0]] * copies[at[1]]
        if times.max(initial=1) == 1:
            return *(first[x].astype(np.int32) for x in at), n
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        of, to = (np.repeat(x, times) for x in at)
        return (first[of] + inside // copies[to]).astype(np.int32), (first[to] + inside % copies[to]).astype(np.int32), np.repeat(n, times)

    def packed(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        name = os.urandom(12).hex()
        order = np.argsort(a.astype(np.int64) << 32 | b)
        a, b, n = a[order], b[order], n[order]
        head = np.concatenate(([True], a[1:] != a[:-1]))
        place = np.arange(len(a)) - np.maximum.accumulate(np.where(head, np.arange(len(a)), 0))
        start = np.flatnonzero(place % most == 0)
        copies = np.where((n > 1) & (n <= REPEATED), n, 1)
        before = np.cumsum(copies) - copies
        a, b, n = a[start], np.repeat(b, copies), np.repeat(np.where(copies > 1, 1, n), copies)
        start = before[start]
        length = np.diff(np.append(start, len(b)))
        several = (np.maximum.reduceat(n, start) != 1) | (np.minimum.reduceat(n, start) != 1)
        counts = np.where(several, np.cumsum(np.where(several, length, 0)) - length, -1)
        store.write(f"to-{name}", b)
        store.write(f"n-{name}", n[np.repeat(several, length)])
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array([name] * len(start)), pa.array(start), pa.array(counts), pa.array(length.astype(np.int32))],
            names=["a", "file", "start", "counts", "length"],
        )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, waiting = None, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal ids
            if ids is None:
                ids = by_number(table, ["product_id"])["product_id"].combine_chunks()
            a, b, n = found(ids, pa.Table.from_batches(held))
            if len(a):
                yield packed(a, b, n)

        for batch in batches:
            held.append(batch)
            waiting += batch.num_rows
            if waiting > gather:
                yield from out()
                held, waiting = [], 0
        if waiting:
            yield from out()

    dealt = edges.select("product_a", "product_b", F.col("n").cast("bigint").alias("n")).repartition("product_a")
    rows = cut(dealt.mapInArrow(write, "a int, file string, start bigint, counts bigint, length int"))
    files = [r[0] for r in rows.select("file").distinct().orderBy("file").collect()]

    def directory(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int32()), ("file", pa.string()), ("start", pa.int64()), ("counts", pa.int64()), ("length", pa.int32())])
        all_ = pa.Table.from_batches([b.cast(schema) for b in batches], schema)
        a = all_.column("a").to_numpy()
        order = np.argsort(a, kind="stable")
        number = {name: i for i, name in enumerate(files)}
        file = all_.column("file").combine_chunks().dictionary_encode()
        parts = file.chunks if isinstance(file, pa.ChunkedArray) else [file]
        which = [np.array([number[x] for x in p.dictionary.to_pylist()], np.int32)[p.indices.to_numpy()] for p in parts if len(p)]
        store.write("file", np.concatenate([np.zeros(0, np.int32), *which])[order])
        for c in ("start", "counts", "length"):
            store.write(c, all_.column(c).to_numpy()[order])
        store.write("first", np.searchsorted(a[order], np.arange(products + 1)))
        yield pa.RecordBatch.from_arrays([pa.array([len(a)])], names=["rows"])

    # A row for each product, or 4096 neighbours: as few as can be read by the one task that brings them in order.
    if files:
        rows.repartition(1).mapInArrow(directory, "rows bigint").collect()
    return Adjacency(store, files, products)


def summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of the values of each."""
    key, value = np.concatenate(keys), np.concatenate(values)
    order = np.argsort(key)
    key, value = key[order], value[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[first], np.add.reduceat(value, first)


def runs(rows: list[tuple[int, np.ndarray, np.ndarray | None]], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct neighbours in order, and the sum of the counts of each; ``entries`` are the neighbours of the rows together."""
    key = np.sort(entries)
    head = np.empty(len(key), bool)
    head[:1] = True
    np.not_equal(key[1:], key[:-1], out=head[1:])
    first = np.flatnonzero(head)
    products, total = key[first], np.diff(first, append=len(key))
    counted = [(to, n) for _, to, n in rows if n is not None]
    if counted:
        # Every entry was taken for one.
        to, n = (np.concatenate(x) for x in zip(*counted))
        other = np.flatnonzero(n != 1)
        np.add.at(total, np.searchsorted(products, to[other]), n[other] - 1)
    return products, total


class Block:
    """Some customers with their attributes, as a stream of batches, and the adjacency rows of what they bought.

    ``customers`` is read once: as it is, or by ``sums``.
    """

    def __init__(self, customers: Iterator[pa.RecordBatch], near: Adjacency, things: str):
        self.customers, self.near, self.things = customers, near, things
        self.marked = np.zeros(near.products, bool)

    def products(self, columns: list[str]) -> dict[str, pa.ChunkedArray]:
        """The columns of the products by number."""
        return by_number(self.things, columns)

    def sums(self) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list]]]]:
        """For each batch of customers: (row in the batch, products, sums, places of the bought ones, pieces of adjacency rows) of
        each customer who bought a product with neighbours.

        Adjacency rows are summed WAITING neighbours at a time, so a customer who bought most products takes no more room.
        """
        for batch in self.customers:
            yield batch, self._sums(batch.column("own"))

    def _sums(self, lists: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, list]]:
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        # A null list has no values.
        for i in range(0, len(lists), TOGETHER):
            ends = offsets[i: i + TOGETHER + 1]
            many, rows = self.near.rows(values[ends[0]: ends[-1]])
            at = np.concatenate(([0], np.cumsum(many)))[ends - ends[0]].tolist()
            for j, (a, b) in enumerate(zip(at, at[1:])):
                if a == b:
                    continue
                own, key, value = [], None, None
                for some in _pieces(rows[a:b]):
                    entries = np.concatenate([to for _, to, _ in some])
                    new = runs(some, entries)
                    key, value = new if key is None else summed(*([x, y] for x, y in zip((key, value), new)))
                    # The entries of a customer with many rows are put together again where they are wanted.
                    own.append((some, entries if b - a <= len(some) else None))
                mine = values[ends[j]: ends[j + 1]]
                place = np.minimum(np.searchsorted(key, mine), len(key) - 1)
                yield i + j, key, value, place[key[place] == mine], own

    def sources(self, own: list, products: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index into ``products``, source, count) for each bought product that leads to one of ``products`` (sorted)."""
        out = []
        self.marked[products] = True
        for some, entries in own:
            key = np.concatenate([to for _, to, _ in some]) if entries is None else entries
            ends = np.cumsum([len(to) for _, to, _ in some])
            hit = np.flatnonzero(self.marked[key])
            row = np.searchsorted(ends, hit, "right")
            count = np.array([1 if some[r][2] is None else some[r][2][h - ends[r]] for r, h in zip(row.tolist(), hit.tolist())], np.int64)
            # Entries of a neighbour stand side by side.
            key = key[hit]
            first = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (row[1:] != row[:-1])))[:len(hit)])
            if len(first):
                count = np.add.reduceat(count, first)
            out.append((np.searchsorted(products, key[first]), np.array([p for p, _, _ in some], np.int64)[row[first]], count))
        self.marked[products] = False
        return tuple(np.concatenate(x) for x in zip(*out))


def _pieces(rows: list) -> Iterator[list]:
    """Adjacency rows in turn, of about WAITING neighbours at once."""
    if len(rows) * NEIGHBOURS * REPEATED <= WAITING:
        yield rows
        return
    some, waiting = [], 0
    for row in rows:
        some.append(row)
        waiting += len(row[1])
        if waiting > WAITING:
            yield some
            some, waiting = [], 0
    if some:
        yield some


def blocked_product(
    history: DataFrame, edges: DataFrame, customers: DataFrame, products: DataFrame,
    finish: Callable[[Block], Iterator[pa.RecordBatch]], schema: str, block: int = BLOCK,
) -> DataFrame:
    """Sums counts over each customer's products, and gives every block of customers to ``finish``.

    ``history`` holds distinct (customer_id, product_id), ``edges`` (product_a, product_b, n) with each pair both ways;
    ``customers`` and ``products`` have unique ids, and attributes for ``finish``.

    This is a sparse matrix product, customers x products by products x products. The second matrix is written once
    (``adjacency``) and the attributes of the products are a written table; workers map the one and read the other, so neither is
    shuffled, however many blocks there are. Purchases are shuffled by product, to be numbered, and by customer. A task takes its
    customers one by one; the table of (customer, product) sums is never shuffled or written.
    """
    spark = history.sparkSession
    people, things = cut(customers), numbered(cut(products), "product_id")
    at = uri(spark, things.inputFiles()[0].rsplit("/", 1)[0])
    near = adjacency(edges, things.count(), at)
    parts = max(3 * spark.sparkContext.defaultParallelism, math.ceil(people.count() / block))
    bought = history.join(things.select("product_id", F.col("number").alias("_a")), "product_id").select("customer_id", "_a")
    own = bought.repartition(parts, "customer_id").groupBy("customer_id").agg(F.collect_list("_a").alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from finish(Block(batches, near, at))

    return people.repartition(parts, "customer_id").join(own, "customer_id", "left").mapInArrow(run, schema)


def sums(history: DataFrame, edges: DataFrame) -> DataFrame:
    """(customer_id, product_id, raw): counts summed over each customer's products, bought ones included.

    Rows come by product within some customers, as such runs take less room where they are written than products in turn.
    """
    history, edges = cut(history), cut(edges)
    customers, products = history.select("customer_id").distinct(), edges.select(F.col("product_a").alias("product_id")).distinct()
    kinds = [df.schema[0].dataType.simpleString() for df in (customers, products)]

    def finish(block: Block) -> Iterator[pa.RecordBatch]:
        name = None
        for batch, each in block.sums():
            found, waiting = [], 0

            def out() -> Iterator[pa.RecordBatch]:
                order = np.concatenate([f[1] for f in found]).astype(np.int64) << 32
                order |= np.repeat(np.arange(len(found)), [len(f[1]) for f in found])
                raw = np.concatenate([f[2] for f in found])
                place = np.argsort(order)
                order, raw = order[place], raw[place]
                who = np.array([f[0] for f in found])
                for at in range(0, len(order), 100_000):
                    some = order[at: at + 100_000]
                    yield pa.RecordBatch.from_arrays([
                        batch.column("customer_id").take(pa.array(who[some & 0xFFFFFFFF])), name.take(pa.array(some >> 32)),
                        pa.array(raw[at: at + 100_000]),
                    ], names=["customer_id", "product_id", "raw"])

            for customer, products, values, _, _ in each:
                name = block.products(["product_id"])["product_id"].combine_chunks() if name is None else name
                found.append((customer, products, values))
                waiting += len(products)
                if waiting > SORTED:
                    yield from out()
                    found, waiting = [], 0
            if found:
                yield from out()

    return blocked_product(history, edges, customers, products, finish, f"customer_id {kinds[0]}, product_id {kinds[1]}, raw bigint")
