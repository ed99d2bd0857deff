"""Near-duplicate vectors: a small-world graph for each shard, every vector asked of every shard, links verified exactly.

Equal vectors are one node. A shard's graph is built by one task; a task that answers takes one graph in and then streams
queries past it, so it holds one shard and one chunk of queries however many there are, and a graph is sent as often as there are
tasks for its shard, a number that the cores of the cluster give and the data do not. A query whose beam is full of links gets a
wider one; an audit (brute force over the shard for some queries, more of them until enough links were seen) doubles the beam until
it finds enough. Links near the threshold are verified in double precision. A task returns counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm import hnsw
from loomspark.llm import textnum as X
from loomspark.llm.common import bounded, materialize, partitions
from loomspark.llm.graph import components

THRESHOLD = 0.95
#: Shards at least, bytes of a shard's vectors at most (about), queries handled at once.
SHARDS, SHARD_BYTES, BLOCK_ROWS = 8, 128 << 20, 4096
BEAM = 32
#: Places in the beams of the queries handled at once, and the beam at which the whole shard is compared instead: this or a share.
FOUND, WIDE, WIDE_SHARE = 4096 * BEAM, 512, 1 / 32
#: Queries that are audited at first, true links to be seen before an audit tells anything, queries after which it is given up (so few
#: have links), and the share of the links that must be found.
AUDIT, AUDIT_LINKS, AUDIT_MOST, RECALL = 128, 100, 8192, 0.99
#: Numbers gathered at once for exact verification.
GATHER = 1 << 22
_NULL = -(1 << 63)


def _raw(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The vectors as they are, one a row."""
    flat = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _unit(raw: np.ndarray) -> np.ndarray:
    x = raw.astype(np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x


def _unit32(raw: np.ndarray) -> np.ndarray:
    out = np.empty(raw.shape, np.float32)
    for k in range(0, len(raw), 8192):
        out[k : k + 8192] = _unit(raw[k : k + 8192])
    return out


def _vectors(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.reshape(-1)))


GRAPH = "dim int, shard int, pos int, node long, members long, embedding array<{kind}>, links array<array<int>>"


def _build(key: tuple, table: pa.Table) -> pa.Table:
    dim, shard = (k.as_py() for k in key)
    node = table["node"].to_numpy()
    draw = (X.mix(node.astype(np.int64).view(np.uint64) + np.uint64(7)) >> np.uint64(11)).astype(np.float64) / 2.0**53
    level = hnsw.levels(np.maximum(draw, 1e-12))
    order = np.lexsort((node, -level))
    v = _raw(table["embedding"])[order]
    graph = hnsw.build(_unit32(v), level[order])
    n = len(order)
    rows = [[g[i].tolist() for g in graph.links if i < len(g)] for i in range(n)]  # from the top level that has the node
    return pa.table(
        {
            "dim": pa.array([dim] * n, pa.int32()), "shard": pa.array([shard] * n, pa.int32()), "pos": pa.array(np.arange(n, dtype=np.int32)), "node": pa.array(node[order]), "members": table["members"].take(pa.array(order)),
            "embedding": _vectors(v), "links": pa.array(rows, pa.list_(pa.list_(pa.int32()))),
        }
    )


ASKED = "node long, links long, a long, b long, found long, true long"
_ASKED = [x.split()[0] for x in ASKED.split(", ")]


class Shard:
    """One graph, the groups that links have joined so far among its rows, and the beam that its audit asks for."""

    def __init__(self, table: pa.Table, threshold: float, width: int):
        table = table.sort_by("pos")
        self.raw = _raw(table["embedding"])
        self.v = _unit32(self.raw)
        self.graph = hnsw.Graph(self.v, *_levels(table["links"].combine_chunks()))
        self.node, self.members = table["node"].to_numpy(), table["members"].to_numpy()
        self.threshold, self.width = threshold, width
        self.doubt = np.float32(max(1e-4, self.v.shape[1] * 2.4e-7))  # more than single precision can be wrong by
        self.group = np.arange(len(self.v))
        self.order = np.argsort(self.node, kind="stable")
        self.sorted = self.node[self.order]
        self.found = self.true = self.audited = 0
        self.told = (0, 0)

    def _linked(self, raw: np.ndarray, r: np.ndarray, c: np.ndarray, sims: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of pairs whose similarity may reach the threshold those that do."""
        ok = sims >= self.threshold + self.doubt
        near = np.flatnonzero(~ok)
        step = max(1, GATHER // raw.shape[1])
        for k in range(0, len(near), step):
            i = near[k : k + step]
            ok[i] = np.einsum("kd,kd->k", _unit(raw[r[i]]), _unit(self.raw[c[i]])) >= self.threshold
        return r[ok], c[ok]

    def _whole(self, raw: np.ndarray, q: np.ndarray, some: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Links of some queries by comparison with every row."""
        low = self.threshold - self.doubt
        for at in range(0, len(some), 256):
            part = some[at : at + 256]
            for k in range(0, len(self.v), 4096):
                sims = q[part] @ self.v[k : k + 4096].T
                r, c = np.nonzero(sims >= low)
                yield self._linked(raw, part[r], c + k, sims[r, c])

    def links(self, raw: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, row) of all found pairs at or over the threshold, in pieces of at most about a million."""
        todo, width, m = np.arange(len(q)), self.width, len(self.v)
        low = self.threshold - self.doubt
        while len(todo) and width < min(m, max(WIDE, int(m * WIDE_SHARE))):
            again = []
            step = max(1, FOUND // width)
            for at in range(0, len(todo), step):
                some = todo[at : at + step]
                ids, sims = self.graph.search(q[some], width)
                full = (sims[:, -1] >= low) & (ids.shape[1] < m)
                again.append(some[full])
                r, c = np.nonzero((sims >= low) & ~full[:, None])
                yield self._linked(raw, some[r], ids[r, c], sims[r, c])
            todo, width = np.concatenate(again), width * 4
        yield from self._whole(raw, q, todo)  # the queries of large groups

    def audit(self, asking: np.ndarray, raw: np.ndarray, q: np.ndarray) -> None:
        """Double the beam until the links of audited queries are found; audit more of them until there were enough links."""
        order = np.argsort(X.mix(asking.astype(np.int64).view(np.uint64) + np.uint64(11)), kind="stable")
        at = 0
        while at < len(order) and self.true < AUDIT_LINKS and self.audited < AUDIT_MOST:
            some = order[at : at + AUDIT]
            at += len(some)
            self.audited += len(some)
            m = np.int64(len(self.v))

            def keys(pairs, some=some, m=m) -> np.ndarray:
                out = [r[asking[some[r]] != self.node[c]] * m + c[asking[some[r]] != self.node[c]] for r, c in pairs]
                return np.unique(np.concatenate([np.zeros(0, np.int64), *out]))

            true = keys(self._whole(raw[some], q[some], np.arange(len(some))))
            while len(true):
                found = np.isin(true, keys(self.links(raw[some], q[some]))).sum()
                if found >= RECALL * len(true) or self.width >= len(self.v):
                    self.found, self.true = self.found + int(found), self.true + len(true)
                    break
                self.width *= 2

    def answer(self, queries: pa.Table) -> pa.Table:
        """Of each query its number of links; and edges that join what links join, at most one for each query and each row in all."""
        asking, raw = queries["node"].to_numpy(), _raw(queries["embedding"])
        q = _unit32(raw)
        self.audit(asking, raw, q)
        count = np.zeros(len(asking), np.int64)
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        at = np.minimum(np.searchsorted(self.sorted, asking), len(self.sorted) - 1)
        first = np.where(self.sorted[at] == asking, self.group[self.order[at]], -1)  # a query that is a row of the shard is in a group
        edges: list[tuple[int, int]] = []
        m = np.int64(len(self.v))
        for r, c in self.links(raw, q):
            other = asking[r] != self.node[c]
            r, c = r[other], c[other]
            count += np.bincount(r, self.members[c], len(asking)).astype(np.int64)
            for pair in np.unique(r * m + self.group[c]).tolist():
                one, at = divmod(pair, int(m))
                if first[one] < 0:
                    first[one] = at
                    edges.append((one, at))
                    continue
                x, y = root(int(first[one])), root(at)
                if x != y:
                    up[max(x, y)] = min(x, y)
                    edges.append((one, at))
            moved = {x: root(x) for x in sorted(up) if root(x) != x}
            if moved:
                old, new = np.array(list(moved), np.int64), np.array(list(moved.values()), np.int64)
                for labels in (self.group, first):
                    spot = np.minimum(np.searchsorted(old, labels), len(old) - 1)
                    labels[:] = np.where(old[spot] == labels, new[spot], labels)
            up.clear()
        e = np.array(edges, np.int64).reshape(-1, 2)
        n, k = len(asking), len(e)
        blank = lambda size: pa.nulls(size, pa.int64())
        join = lambda *x: pa.concat_arrays([y if isinstance(y, pa.Array) else pa.array(y, pa.int64()) for y in x])
        columns = [join(asking, blank(k + 1)), join(count, blank(k + 1)), join(blank(n), asking[e[:, 0]], blank(1)), join(blank(n), self.node[e[:, 1]], blank(1)), join(blank(n + k), [self.found - self.told[0]]), join(blank(n + k), [self.true - self.told[1]])]
        self.told = (self.found, self.true)
        return pa.table(columns, names=_ASKED)


def _levels(links: pa.ListArray) -> tuple[list[int], list[np.ndarray]]:
    depth = np.diff(links.offsets.to_numpy())
    lists = links.flatten()
    size = np.diff(lists.offsets.to_numpy())
    start = X.starts_of(size)
    values = lists.flatten().to_numpy()
    first = X.starts_of(depth)
    found = []
    for up in range(int(depth.max(initial=1)) - 1, -1, -1):  # the last list of a node is that of level 0
        nodes = np.flatnonzero(depth > up)
        which = first[nodes + 1] - 1 - up
        width = int(size[which[0]])
        found.append(values[X.ranges(start[which], size[which])].reshape(len(nodes), width))
    return [len(x) for x in found], found


def _ask(key: tuple, shard: pa.Table, queries: pa.Table, threshold: float, width: int, chunk: int = BLOCK_ROWS) -> pa.Table:
    one = Shard(shard, threshold, width)
    return pa.concat_tables([one.answer(queries.slice(k, chunk)) for k in range(0, len(queries), chunk)])


def _answers(batches: Iterator[pa.RecordBatch], threshold: float, width: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by task; of each task the rows of its graph (with links) come first, then its queries."""
    held: list[pa.RecordBatch] = []
    count = 0
    now, shard = None, None

    def done() -> Iterator[pa.RecordBatch]:
        nonlocal held, count
        if shard is not None and held:
            yield from shard.answer(pa.Table.from_batches(held)).to_batches()
        held, count = [], 0

    for batch in batches:
        task, graph = batch.column("task").to_numpy(), batch.column("links").is_valid().to_numpy(zero_copy_only=False)
        cut = [0, *(np.flatnonzero((task[1:] != task[:-1]) | (graph[1:] != graph[:-1])) + 1), len(batch)]
        for a, b in zip(cut, cut[1:], strict=False):
            if a == b:
                continue
            if task[a] != now:
                yield from done()
                now, shard = task[a], None
            if graph[a]:
                held.append(batch.slice(a, b - a))
                continue
            if shard is None:
                if not held:
                    raise ValueError("queries without a graph")
                shard = Shard(pa.Table.from_batches(held), threshold, width)
                held = []
            for k in range(a, b, chunk):
                held.append(batch.slice(k, min(chunk, b - k)))
                count += held[-1].num_rows
                if count >= chunk:
                    yield from done()
    yield from done()


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
g AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, least(a, min(b)) AS c FROM r GROUP BY a), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept, CASE WHEN EXISTS (SELECT 1 FROM l) THEN 1.0::DOUBLE END AS audited_recall
FROM v LEFT JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a
""".replace("WITH v", "WITH RECURSIVE v")


def embedding_dedup(vectors: DataFrame, threshold: float = THRESHOLD, width: int = BEAM) -> DataFrame:
    """Per row of vectors (vec_id, embedding): vec_id, n_links, component_id, kept (vec_id = component_id), audited_recall.

    n_links counts the other rows with a cosine of at least ``threshold`` that were found; component_id is the smallest vec_id
    reachable by links. Vectors that are null, zero, or hold null or non-finite components link with nothing; vectors of
    different lengths do not link. Equal vectors always do. A null vec_id counts as the least. vec_id is taken for a key: rows that
    share one and differ in vector have one component and the links of both. audited_recall is the share of the true links of audited queries that were found, the same in every row, null where none had links. Other
    columns, whatever their names, are not read. Empty gives empty.
    """
    spark = vectors.sparkSession
    real = F.col("embedding").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", F.coalesce(F.col("vec_id").cast("long"), F.lit(_NULL)).alias("d"), "embedding", F.coalesce(real, F.lit(False)).alias("real"))
    rows = rows.withColumns({"k1": F.xxhash64("embedding"), "k2": F.xxhash64(F.lit(1), "embedding")})
    classes = rows.filter("real").groupBy("k1", "k2").agg(F.min("d").alias("node"), F.count("*").alias("members"), F.first("embedding").alias("embedding"))
    reps = materialize(classes.select("*", F.size("embedding").alias("dim")))
    held = reps.groupBy("dim").agg(F.count("*").alias("n"))
    held = held.agg(F.max(F.col("n") * F.col("dim")).alias("most")).first()["most"] or 0
    shards = max(SHARDS, -(-held * 8 // SHARD_BYTES))
    blocks = max(1, -(-spark.sparkContext.defaultParallelism // shards))  # by cores, not by rows
    placed = reps.select("dim", F.pmod(F.xxhash64("node"), F.lit(shards)).cast("int").alias("shard"), "node", "members", "embedding")
    kind = dict(reps.dtypes)["embedding"].removeprefix("array<").removesuffix(">")
    graphs = materialize(placed.groupBy("dim", "shard").applyInArrow(_build, GRAPH.format(kind=kind)))
    each = F.sequence(F.lit(0), F.lit(blocks - 1))
    sent = graphs.select("dim", "shard", F.explode(each).alias("block"), "pos", "node", "members", "embedding", "links")
    there = graphs.groupBy("dim").agg(F.collect_set("shard").alias("shards"))  # a dimension of few vectors does not fill every shard
    asked = reps.join(there, "dim").select("dim", F.explode("shards").alias("shard"), F.pmod(F.xxhash64(F.lit(5), "node"), F.lit(blocks)).cast("int").alias("block"), F.lit(None).cast("int").alias("pos"), "node", "members", "embedding")
    task = (F.col("dim").cast("long") * shards + F.col("shard")) * blocks + F.col("block")
    n = partitions(spark)
    dealt = bounded(sent.unionByName(asked, allowMissingColumns=True)).withColumn("task", task).repartitionById(n, F.pmod("task", F.lit(n)).cast("int"))
    dealt = dealt.sortWithinPartitions("task", F.col("pos").asc_nulls_last()).select("task", "pos", "node", "members", "embedding", "links")
    chunk = BLOCK_ROWS
    answers = materialize(dealt.mapInArrow(lambda it: _answers(it, threshold, width, chunk), ASKED))
    seen = answers.agg(F.sum("found").alias("found"), F.sum("true").alias("true")).first()
    recall = seen["found"] / seen["true"] if seen["true"] else None
    count = answers.filter("node is not null").groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(answers.filter("a is not null").select("a", "b"))
    led = reps.select("k1", "k2", "node", "members").join(count, "node", "left").join(joined, "node", "left")
    led = led.select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.coalesce("component", "node").alias("component"))
    linked = rows.filter("real").select("vec_id", "d", "k1", "k2").join(materialize(led), ["k1", "k2"]).select("vec_id", "d", "n_links", "component")
    alone = rows.filter("not real").select("vec_id", "d", F.lit(0).cast("long").alias("n_links"), F.col("d").alias("component"))
    out = linked.unionByName(alone)  # rows that link with nothing share their keys and are not joined
    component = F.col("component")
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.when(component != _NULL, component).alias("component_id"), (component == F.col("d")).alias("kept"), F.lit(recall).cast("double").alias("audited_recall"))
