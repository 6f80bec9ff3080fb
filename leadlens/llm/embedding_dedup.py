"""Embedding near-dedup with small-world graphs per shard (operator 8).

Vectors are dealt to shards by hash.  Each shard builds a hierarchical
navigable small-world graph: a vector stands in the layers up to a random
level, and in each layer it keeps links to near vectors in different
directions (a candidate nearer to a kept link than to the vector is left
out).  Every vector is a query against every shard: greedy descent through
the upper layers, a beam search in the lowest, then, from the hits, on
through the links of hits until no new vector within the threshold is met,
so a group of any size is collected whole.  Cosines are computed in double
precision before a link counts.

Equal vectors are one node with a number of copies, so a vector repeated on a
third of the rows is compared once.  Vectors of each length have shards of
their own.

The beam is widened until its audit passes: the links of some ``AUDITED``
queries are compared with brute force over all vectors, and pooled over the
shards by class of a query's true number of links (powers of two; classes with
fewer than ``AUDIT_LINKS`` audited links are one class).  Each class must reach
the bound, so a large group does not decide for ordinary vectors.  If the
widest beam fails, all is searched exactly, in blocks.

Tasks hand on one row per query and shard with the number of links, and a
spanning forest of the links (at most as many rows as vectors), not pairs.

Shards hold ``SHARD_ROWS`` vectors and query blocks ``BLOCK_ROWS`` queries,
whatever the table's size, so memory is bounded.

Defined cases: null vectors, zero vectors and vectors with null or non-finite
components link with nothing; each row is compared, and rows with one vec_id
share their links and component; a null vec_id links with nothing; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import components, materialise
from .shingles import mix

THRESHOLD = 0.9
SHARDS = 6                   # of a length, at least, once it has SMALL vectors for each
SMALL = 1000
SHARD_ROWS = 100_000
BLOCK_ROWS = 25_000
LINKS = 12                   # per vector in a layer, twice as many in the lowest
BEAM, MAX_BEAM = 24, 384
RECALL = 0.97
EXACT_ROWS = 64              # queries compared exactly in one call
AUDITED = 2000               # queries audited, about (all, if there are fewer)
AUDIT_LINKS = 100            # of a class that is judged by itself
SALTS = 64                   # parts in which copies of a vector are counted
PAIRS = 200_000              # cosines computed in one call


def unit_rows(raw: np.ndarray) -> np.ndarray:
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def usable(embedding: Column) -> Column:
    ok = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(ok & F.exists(embedding, lambda x: x != 0), F.lit(False))


class Graph:
    """Layers of links over the rows of ``x`` (unit vectors)."""

    def __init__(self, x: np.ndarray, level: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.level, self.layers = x, level, layers     # layer: (node numbers, links by node, -1 for none)

    @classmethod
    def build(cls, x: np.ndarray, ids: np.ndarray) -> "Graph":
        u = (mix(ids.astype(np.int64).view(np.uint64)) >> np.uint64(11)).astype(np.float64) / 2**53
        level = np.floor(-np.log(np.maximum(u, 1e-300)) / np.log(LINKS)).astype(int)
        graph = cls(x, level, [])
        for k in range(int(level.max(initial=0)), -1, -1):
            graph.layers.insert(0, graph._layer(np.flatnonzero(level >= k), LINKS * (2 if k == 0 else 1)))
        return graph

    def _layer(self, nodes: np.ndarray, links: int):
        """Insert the nodes of a layer in growing groups: each group is
        searched for in what stands already and compared within itself."""
        table = np.full((len(self.x), links), -1, dtype=np.int32)
        done, layer = 0, (nodes, table)
        while done < len(nodes):
            group = nodes[done:done + min(1024, max(32, done))]
            inside = self.x[group] @ self.x[group].T
            np.fill_diagonal(inside, -2)
            k = min(links, len(group) - 1)
            near = np.argpartition(-inside, k, axis=1)[:, :k] if k else np.zeros((len(group), 0), dtype=int)
            found = [group[near]]
            if done:
                found.append(self._beam(self.x[group], layer, nodes[:done], 3 * links)[0])
            self._link(table, group, np.concatenate(found, axis=1))
            done += len(group)
        return layer

    def _link(self, table: np.ndarray, group: np.ndarray, found: np.ndarray) -> None:
        back: dict[int, list[int]] = {}
        for g, row in zip(group.tolist(), found, strict=True):
            table[g] = self._choose(g, row[row >= 0], table.shape[1])
            for v in table[g][table[g] >= 0].tolist():
                back.setdefault(v, []).append(g)
        for v, new in back.items():
            old = table[v][table[v] >= 0]
            both = np.unique(np.concatenate([old, np.array(new, dtype=np.int32)]))
            table[v] = self._choose(v, both[both != v], table.shape[1])

    def _choose(self, v: int, found: np.ndarray, links: int) -> np.ndarray:
        """Near vectors in different directions first, then the nearest left out."""
        out = np.full(links, -1, dtype=np.int32)
        if len(found) == 0:
            return out
        found = np.unique(found)
        sims = self.x[found] @ self.x[v]
        order = np.argsort(-sims, kind="stable")[:4 * links]
        found, sims = found[order], sims[order]
        between = self.x[found] @ self.x[found].T
        kept, left = [], []
        for i in range(len(found)):
            if len(kept) == links:
                break
            (left if kept and (between[i, kept] > sims[i]).any() else kept).append(i)
        kept += left[:links - len(kept)]
        out[:len(kept)] = found[kept]
        return out

    def _beam(self, q: np.ndarray, layer, standing: np.ndarray, width: int, start: np.ndarray | None = None):
        """Beam search of many queries at once: (nodes, cosines), -1 for none."""
        _, table = layer
        m, width = len(q), min(width, max(1, len(standing)))
        if len(standing) <= 2 * width:
            sims = q @ self.x[standing].T
            top = np.argsort(-sims, axis=1)[:, :width]
            return standing[top].astype(np.int32), np.take_along_axis(sims, top, axis=1)
        rows = np.arange(m)
        best = np.full((m, width), -1, dtype=np.int32)
        sims = np.full((m, width), -2.0)
        open_ = np.zeros((m, width), dtype=bool)
        seen = np.zeros((m, len(self.x)), dtype=bool)
        first = standing[np.linspace(0, len(standing) - 1, min(4, width)).astype(int)] if start is None else None
        first = np.broadcast_to(first, (m, len(first))) if start is None else start
        first = first[:, :width]
        ok = first >= 0
        best[:, :first.shape[1]] = first
        sims[:, :first.shape[1]] = np.where(ok, np.einsum("ijk,ik->ij", self.x[first], q), -2)
        open_[:, :first.shape[1]] = ok
        seen[rows[:, None], np.where(ok, first, 0)] |= ok
        live = rows
        while len(live):
            s = np.where(open_[live], sims[live], -3)
            at = s.argmax(axis=1)
            go = s[np.arange(len(live)), at] > -2.5
            live, at = live[go], at[go]
            if not len(live):
                break
            open_[live, at] = False
            near = table[best[live, at]]
            new = (near >= 0) & ~seen[live[:, None], near]
            seen[live[:, None], np.where(new, near, 0)] |= new
            c = np.where(new, np.einsum("ijk,ik->ij", self.x[near], q[live]), -2.0)
            all_s = np.concatenate([sims[live], c], axis=1)
            all_b = np.concatenate([best[live], np.where(new, near, -1)], axis=1)
            all_o = np.concatenate([open_[live], new], axis=1)
            top = np.argpartition(-all_s, width - 1, axis=1)[:, :width]
            sims[live] = np.take_along_axis(all_s, top, axis=1)
            best[live] = np.take_along_axis(all_b, top, axis=1)
            open_[live] = np.take_along_axis(all_o, top, axis=1)
        return best, sims

    def within(self, q: np.ndarray, beam: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs with cosine >= threshold that the search meets."""
        start = None
        for k in range(len(self.layers) - 1, 0, -1):
            start = self._beam(q, self.layers[k], self.layers[k][0], 4, start)[0]
        best, sims = self._beam(q, self.layers[0], self.layers[0][0], beam, start)
        a, b = np.nonzero((best >= 0) & (sims >= threshold))
        key = np.unique(a.astype(np.int64) * len(self.x) + best[a, b])
        fresh, table = key, self.layers[0][1]
        while len(fresh):
            i, v = fresh // len(self.x), fresh % len(self.x)
            near = table[v]
            i, near = np.repeat(i, near.shape[1]), near.ravel()
            nxt = np.unique(i[near >= 0] * len(self.x) + near[near >= 0])
            nxt = nxt[~np.isin(nxt, key)]
            hit = np.concatenate([np.zeros(0, dtype=bool), *(
                np.einsum("ij,ij->i", self.x[part % len(self.x)], q[part // len(self.x)]) >= threshold
                for part in np.array_split(nxt, -(-len(nxt) // PAIRS)))]) if len(nxt) else np.zeros(0, dtype=bool)
            fresh = nxt[hit]
            key = np.union1d(key, fresh)
        return key // len(self.x), key % len(self.x)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (u, v) of the links a - b between ids."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[:len(a)], at[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    hit = label != np.arange(len(nodes))
    return nodes[hit], nodes[label[hit]]


def nodes(good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (node, v, copies, owner: the smallest vec_id, dims,
    shard) and the rows' nodes (vec_id, node).  Copies are counted in parts."""
    salted = good.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    parts = materialise(salted.groupBy("v", "salt").agg(F.count(F.lit(1)).alias("c"), F.min("vec_id").alias("low")), "vector-parts")
    whole = materialise(parts.groupBy("v").agg(F.sum("c").alias("copies"), F.min("low").alias("owner"))
                        .withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    members = salted.join(parts.select("v", "salt").join(whole.select("v", "node"), "v"), ["v", "salt"]).select("vec_id", "node")
    sizes = whole.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).select("dims", F.greatest(
        F.ceil(F.col("n") / SHARD_ROWS), F.least(F.lit(SHARDS), F.ceil(F.col("n") / SMALL))).alias("of"))
    dealt = whole.withColumn("dims", F.size("v")).join(sizes, "dims").withColumn(
        "shard", F.xxhash64("dims", F.pmod(F.xxhash64("node"), F.col("of")))).drop("of")
    return materialise(dealt, "vectors"), materialise(members, "vector-members")


def _build(vectors: DataFrame) -> DataFrame:
    """One row per shard and vector: its number, vector, level and links."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        graph = Graph.build(unit_rows(np.stack(pdf["v"])), pdf["node"].to_numpy())
        links = [[t[k][t[k] >= 0] for _, t in graph.layers[:graph.level[k] + 1]] for k in range(len(pdf))]
        return pd.DataFrame({"shard": pdf["shard"], "number": np.arange(len(pdf)), "node": pdf["node"], "v": pdf["v"],
                             "copies": pdf["copies"], "links": links})

    return vectors.select("shard", "node", "v", "copies").groupBy("shard").applyInPandas(
        run, "shard long, number int, node long, v array<double>, copies long, links array<array<int>>")


def _load(pdf: pd.DataFrame) -> Graph:
    level = np.array([len(x) for x in pdf["links"]]) - 1
    layers = []
    for k in range(int(level.max()) + 1):
        table = np.full((len(pdf), LINKS * (2 if k == 0 else 1)), -1, dtype=np.int32)
        at = np.flatnonzero(level >= k)
        for g in at.tolist():
            row = pdf["links"][g][k]
            table[g, :len(row)] = row
        layers.append((at, table))
    return Graph(unit_rows(np.stack(pdf["v"])), level, layers)


def _search(index: DataFrame, queries: DataFrame, shards: DataFrame, blocks: int, beam: int | None,
            threshold: float) -> DataFrame:
    """Query the shards of a vector's length with it, by beam search or,
    without a beam, exactly.  Rows: kind 0 (u = node, n = rows linked with it in
    the shard) and kind 1 (u, v: forest of the links)."""
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(blocks)).cast("int")
    q = queries.join(shards, "dims").select("node", "v", "shard", block.alias("block"))
    ix = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"kind": [], "u": [], "v": [], "n": []}, dtype="int64")]
        if len(left) and len(right):
            right = right.sort_values("number", ignore_index=True)
            ids, copies = right["node"].to_numpy(), right["copies"].to_numpy()
            graph, x = (_load(right), None) if beam else (None, unit_rows(np.stack(right["v"])))
            step = 512 if beam else EXACT_ROWS
            for at in range(0, len(left), step):
                part = left.iloc[at:at + step]
                own, q = part["node"].to_numpy(), unit_rows(np.stack(part["v"]))
                a, b = graph.within(q, beam, threshold) if beam else np.nonzero(q @ x.T >= threshold)
                a, b = own[a][own[a] != ids[b]], b[own[a] != ids[b]]
                u, which = np.unique(a, return_inverse=True)
                c, d = forest(a, ids[b])
                n = np.bincount(which, weights=copies[b], minlength=len(u)).astype(np.int64)
                out += [pd.DataFrame({"kind": 0, "u": u, "v": u, "n": n}), pd.DataFrame({"kind": 1, "u": c, "v": d, "n": 0})]
        return pd.concat(out)

    return q.groupBy("shard", "block").cogroup(ix.groupBy("shard", "block")).applyInPandas(
        run, "kind int, u long, v long, n long")


def recall_by_class(truth: DataFrame, found: DataFrame) -> DataFrame:
    """(size, links, recall): of the audited queries' links, by class of a
    query's number of links; size -1 pools the classes with few links."""
    n = lambda df, c: df.where("kind = 0").groupBy("u").agg(F.sum("n").alias(c))
    both = n(truth, "n_true").join(n(found, "n"), "u", "left").withColumn("got", F.least("n_true", F.coalesce("n", F.lit(0))))
    by = both.groupBy(F.floor(F.log2("n_true")).cast("int").alias("size")).agg(
        F.sum("n_true").alias("links"), F.sum("got").alias("got"))
    return by.groupBy(F.when(F.col("links") >= AUDIT_LINKS, F.col("size")).otherwise(-1).alias("size")).agg(
        F.sum("links").alias("links"), (F.sum("got") / F.sum("links")).alias("recall"))


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``table``."""
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    vectors, members = nodes(rows.where(F.col("vec_id").isNotNull() & usable(F.col("v"))))
    shards = vectors.select("dims", "shard").distinct()
    n = vectors.count()
    blocks = max(1, -(-n // BLOCK_ROWS))
    queries = vectors.select("node", "v", "dims")
    index = materialise(_build(vectors), "vector-graphs")
    audited = queries.where(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(max(1, n // AUDITED))) == 0)
    truth = materialise(_search(index, audited, shards, 1, None, threshold), "vector-audit")
    beam: int | None = BEAM
    while True:
        found = materialise(_search(index, queries, shards, blocks, beam, threshold), f"vector-links-{beam or 'exact'}")
        if beam is None or recall_by_class(truth, found).where(F.col("recall") < recall).isEmpty():
            break
        beam = 4 * beam if 4 * beam <= MAX_BEAM else None
    counts = found.where("kind = 0").groupBy("u").agg(F.sum("n").alias("n"))
    known = vectors.select("node", "owner", "copies").join(counts, F.col("node") == F.col("u"), "left").select(
        "node", "owner", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"))
    of_rows = members.join(known, "node").groupBy("vec_id").agg(F.sum("n").alias("n"))
    # links between owners, and of each vec_id with the owners of its vectors
    owner = lambda c: vectors.select(F.col("node").alias(c), F.col("owner").alias(f"{c}_owner"))
    linked = (found.where("kind = 1").select("u", "v").distinct().join(owner("u"), "u").join(owner("v"), "v")
              .select(F.col("u_owner").alias("u"), F.col("v_owner").alias("v")))
    same = members.join(known, "node").select(F.col("vec_id").alias("u"), F.col("owner").alias("v")).where("u <> v")
    joined = components(linked.unionAll(same).distinct(), "vector-components")
    out = (table.select("vec_id").join(of_rows.select("vec_id", "n"), "vec_id", "left")
           .join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left"))
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      (component == F.col("vec_id")).alias("kept"))


def op8_hnsw_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
