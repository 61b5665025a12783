"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

1. Equal vectors count as one, with their ``top`` + 1 smallest ids (no more can be among an answer's ``top``). Shards of
   about ``shard_rows`` vectors are dealt by hash.
2. Each shard becomes one graph, a row of flat arrays: vectors, and for each layer its nodes and their neighbours (a matrix
   filled up with -1). Inner products are made a metric by one more dimension, which gives all vectors of a shard one
   length (zero in a query). Nodes are inserted and searched many at a time: a batch walks in step, the neighbours of all
   its best candidates looked up in one indexing and scored in one product.
3. Queries go to every shard, in blocks of about ``query_rows``; a shard answers from its graph, rescored in double
   precision on the original vectors. The answers of all shards are ranked by score, ties to the smaller id.

Null, zero, ragged and non-finite vectors and null ids take no part, as queries or as answers. Rows that repeat an id and its
vector count as one candidate. With fewer than ``top`` candidates all are returned. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowjudge.llm.common import stored
from rowjudge.llm.vectors import flagged


@dataclass(frozen=True)
class HnswConfig:
    """links: neighbours of a node (twice as many in the lowest layer); build, search: breadth of the candidate lists."""

    top: int = 20
    links: int = 16
    build: int = 64
    search: int = 160
    shard_rows: int = 8192
    query_rows: int = 1024
    batch: int = 512
    seed: int = 11


class Graph:
    """layers: from the lowest; each (nodes, neighbours as places in that layer)."""

    def __init__(self, vectors: np.ndarray, cfg: HnswConfig, layers: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.cfg, self.original = cfg, vectors
        length = (vectors * vectors).sum(1)
        more = np.sqrt(np.maximum(length.max() - length, 0))[:, None] if len(vectors) else np.zeros((0, 1))
        self.x = np.concatenate([vectors, more], 1).astype(np.float32)
        self.layers = layers if layers is not None else []
        if layers is None and len(vectors):
            self._build()

    def _build(self) -> None:
        n, rng = len(self.x), np.random.default_rng(self.cfg.seed)
        level = np.floor(-np.log(1 - rng.random(n)) / math.log(self.cfg.links)).astype(int)
        order = np.lexsort((rng.random(n), -level))  # a layer's nodes come first in every layer below
        for at in range(level.max(), -1, -1):
            nodes = order[: int((level >= at).sum())]
            self.layers.insert(0, self._layer(nodes, 2 * self.cfg.links if at == 0 else self.cfg.links))

    def _layer(self, nodes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        x = self.x[nodes]
        near = np.full((len(nodes), width), -1, np.int32)
        done = 0
        while done < len(nodes):
            take = min(len(nodes) - done, self.cfg.batch, max(done, 64))
            new = np.arange(done, done + take)
            ids, sims = (self._walk(x[new], x[:done], near[:done], self._enter(x[new], done), self.cfg.build) if done
                         else (np.zeros((take, 0), np.int64), np.zeros((take, 0), np.float32)))
            among = x[new] @ x[new].T
            np.fill_diagonal(among, -np.inf)
            best = np.argsort(-among, 1, kind="stable")[:, : self.cfg.build]
            ids, sims = np.concatenate([ids, best + done], 1), np.concatenate([sims, np.take_along_axis(among, best, 1)], 1)
            near[new] = self._choose(x, ids, sims, width)
            self._link_back(x, near, new, width)
            done += take
        return nodes, near

    def _choose(self, x: np.ndarray, ids: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """The most similar candidates that are nearer to the node than to one chosen before; room left goes to the next best."""
        out = np.full((len(ids), width), -1, np.int32)
        order = np.argsort(-sims, 1, kind="stable")[:, : max(self.cfg.build, width)]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        for at in range(0, len(ids), 256):
            i, s = ids[at: at + 256], sims[at: at + 256]
            valid = np.isfinite(s)
            v = x[np.where(valid, i, 0)]
            gram = v @ v.transpose(0, 2, 1)
            crowd = np.full(s.shape, -np.inf, np.float32)
            chosen, count = np.zeros(s.shape, bool), np.zeros(len(s), int)
            for j in range(s.shape[1]):
                ok = valid[:, j] & (crowd[:, j] < s[:, j]) & (count < width)
                chosen[:, j] = ok
                count += ok
                crowd = np.where(ok[:, None], np.maximum(crowd, gram[:, j]), crowd)
            rank = np.where(chosen, 0, np.where(valid, 1, 2))
            first = np.argsort(rank, 1, kind="stable")[:, :width]
            picked = np.take_along_axis(np.where(valid, i, -1), first, 1)
            out[at: at + 256, : picked.shape[1]] = picked
        return out

    def _link_back(self, x: np.ndarray, near: np.ndarray, new: np.ndarray, width: int) -> None:
        source = np.repeat(new, width)
        target = near[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        have = (near[target] == source[:, None]).any(1)
        source, target = source[~have], target[~have]
        if not len(target):
            return
        sim = np.einsum("ij,ij->i", x[source], x[target])
        order = np.lexsort((-sim, target))
        source, target = source[order], target[order]
        nodes, start, count = np.unique(target, return_index=True, return_counts=True)
        rank = np.arange(len(target)) - np.repeat(start, count)
        close = rank < width  # more than fit are never all kept
        fresh = np.full((len(nodes), min(width, int(count.max()))), -1, np.int64)
        fresh[np.repeat(np.arange(len(nodes)), count)[close], rank[close]] = source[close]
        ids = np.concatenate([near[nodes], fresh], 1).astype(np.int64)
        room = (ids >= 0).sum(1) <= width
        packed = np.take_along_axis(ids, np.argsort(ids < 0, 1, kind="stable")[:, :width], 1)
        near[nodes[room]] = packed[room]
        full = np.flatnonzero(~room)
        for at in range(0, len(full), 1024):
            part = full[at: at + 1024]
            own = ids[part]
            sims = np.einsum("ij,ikj->ik", x[nodes[part]], x[np.maximum(own, 0)])
            sims[own < 0] = -np.inf
            near[nodes[part]] = self._choose(x, own, sims, width)

    def _enter(self, q: np.ndarray, done: int) -> np.ndarray:
        """Places to start from in a layer of which ``done`` nodes are in: a narrow walk down the layers above it."""
        start = np.zeros((len(q), 1), np.int64)
        for nodes, near in reversed(self.layers):
            start = self._walk(q, self.x[nodes], near, start, 4)[0]
        return np.where((start < 0) | (start >= done), 0, start)

    def _walk(self, q: np.ndarray, x: np.ndarray, near: np.ndarray, start: np.ndarray, breadth: int) -> tuple[np.ndarray, np.ndarray]:
        """The best ``breadth`` places found for each query, with similarities, best first; -1 and -inf where fewer."""
        n, rows = len(q), np.arange(len(q))
        seen = np.zeros((n, len(x) + 1), bool)
        seen[:, -1] = True  # the place of no neighbour
        first = np.sort(start, 1)
        fresh = np.ones(first.shape, bool)
        fresh[:, 1:] = first[:, 1:] != first[:, :-1]
        seen[rows[:, None], first] = True
        sims = np.where(fresh, np.einsum("ij,ikj->ik", q, x[first]), -np.inf).astype(np.float32)
        ids = np.full((n, breadth), -1, np.int64)
        score = np.full((n, breadth), -np.inf, np.float32)
        open_ = np.zeros((n, breadth), bool)
        k = min(breadth, first.shape[1])
        order = np.argsort(-sims, 1, kind="stable")[:, :k]
        score[:, :k] = np.take_along_axis(sims, order, 1)
        ids[:, :k] = np.where(np.isfinite(score[:, :k]), np.take_along_axis(first, order, 1), -1)
        open_[:, :k] = ids[:, :k] >= 0
        wide = min(4, breadth)
        live = rows
        while len(live):
            rank = np.where(open_[live], np.arange(breadth), breadth)
            pick = np.sort(np.argpartition(rank, wide - 1, 1)[:, :wide], 1)
            usable = np.take_along_axis(open_[live], pick, 1)
            some = usable.any(1)
            live, pick, usable = live[some], pick[some], usable[some]
            if not len(live):
                break
            at = np.where(usable, ids[live[:, None], pick], -1)
            open_[live[:, None], pick] = False
            step = np.where(at[:, :, None] >= 0, near[np.maximum(at, 0)], -1).reshape(len(live), -1)
            step = np.where(step < 0, len(x), step)
            step.sort(1)
            known = seen[live[:, None], step]
            known[:, 1:] |= step[:, 1:] == step[:, :-1]
            seen[live[:, None], step] = True
            most = int((~known).sum(1).max())
            if not most:
                continue
            step = np.take_along_axis(np.where(known, len(x), step), np.argsort(known, 1, kind="stable")[:, :most], 1)
            gain = np.einsum("ij,ikj->ik", q[live], x[np.minimum(step, len(x) - 1)])
            gain[step == len(x)] = -np.inf
            all_score = np.concatenate([score[live], gain], 1)
            all_ids = np.concatenate([ids[live], np.where(step == len(x), -1, step)], 1)
            all_open = np.concatenate([open_[live], step < len(x)], 1)
            best = np.argpartition(-all_score, breadth - 1, 1)[:, :breadth]
            best = np.take_along_axis(best, np.argsort(-np.take_along_axis(all_score, best, 1), 1, kind="stable"), 1)
            score[live] = np.take_along_axis(all_score, best, 1)
            ids[live] = np.take_along_axis(all_ids, best, 1)
            open_[live] = np.take_along_axis(all_open, best, 1)
        return ids, score

    def search(self, q: np.ndarray) -> np.ndarray:
        """Places (rows of ``vectors``) of the candidates for each query, -1 where fewer."""
        if not len(self.x):
            return np.zeros((len(q), 0), np.int64)
        q = np.concatenate([q, np.zeros((len(q), 1))], 1).astype(np.float32)
        start = np.zeros((len(q), 1), np.int64)
        for nodes, near in self.layers[:0:-1]:
            start = np.maximum(self._walk(q, self.x[nodes], near, start, 4)[0], 0)
        nodes, near = self.layers[0]
        found, _ = self._walk(q, self.x[nodes], near, start, max(self.cfg.search, self.cfg.top + 1))
        return np.where(found < 0, -1, nodes[found])


_GRAPH = "shard int, n int, ids array<array<long>>, vectors binary, nodes array<binary>, near array<binary>, widths array<int>"


def _builder(cfg: HnswConfig):
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["k1", "k2"])
        x = np.stack(pdf["embedding"].to_numpy())
        graph = Graph(x, cfg)
        return pd.DataFrame([{
            "shard": pdf["shard"].iloc[0], "n": len(x), "ids": [list(i) for i in pdf["ids"]], "vectors": x.tobytes(),
            "nodes": [a.astype("<i4").tobytes() for a, _ in graph.layers], "near": [b.astype("<i4").tobytes() for _, b in graph.layers],
            "widths": [b.shape[1] for _, b in graph.layers]}])

    return build


def build_index(rows: DataFrame, cfg: HnswConfig = HnswConfig()) -> DataFrame:
    """A row for each shard's graph, from ``rows`` (vec_id, embedding, k1, k2)."""
    smallest = Window.partitionBy("k1", "k2").orderBy("vec_id")
    once = rows.select("k1", "k2", "vec_id").distinct()
    ids = once.withColumn("rank", F.row_number().over(smallest)).where(F.col("rank") <= cfg.top + 1)
    ids = ids.groupBy("k1", "k2").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))  # top + 1 at most
    vectors = rows.groupBy("k1", "k2").agg(F.first("embedding").alias("embedding"))
    distinct = stored(vectors.join(ids, ["k1", "k2"]), "points")
    shards = max(1, math.ceil(distinct.count() / cfg.shard_rows))
    dealt = distinct.withColumn("shard", F.pmod(F.col("k1"), F.lit(shards)).cast("int"))
    return stored(dealt.groupBy("shard").applyInPandas(_builder(cfg), _GRAPH), "graphs")


def _searcher(cfg: HnswConfig):
    def search(key, queries: pd.DataFrame, graphs: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(graphs):
            g = graphs.iloc[0]
            x = np.frombuffer(g["vectors"]).reshape(g["n"], -1)
            layers = [(np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4").reshape(-1, w)) for a, b, w in zip(g["nodes"], g["near"], g["widths"])]
            graph = Graph(x, cfg, layers)
            ids = [np.asarray(i) for i in g["ids"]]
            for at in range(0, len(queries), cfg.batch):
                part = queries.iloc[at: at + cfg.batch]
                q = np.stack(part["embedding"].to_numpy())
                for own, vector, found in zip(part["vec_id"], q, graph.search(q)):
                    found = found[found >= 0]
                    exact = x[found] @ vector
                    who = np.concatenate([ids[i] for i in found])
                    score = np.repeat(exact, [len(ids[i]) for i in found])
                    keep = who != own
                    who, score = who[keep], score[keep]
                    best = np.lexsort((who, -score))[: cfg.top]
                    out["query_id"].append(np.full(len(best), own))
                    out["vec_id"].append(who[best])
                    out["score"].append(score[best])
        return pd.DataFrame({k: np.concatenate(v) if v else [] for k, v in out.items()})

    return search


def search(queries: DataFrame, graphs: DataFrame, cfg: HnswConfig = HnswConfig()) -> DataFrame:
    """query_id, rank, vec_id, score of each query's nearest, from ``queries`` (vec_id, embedding)."""
    queries = stored(queries.select("vec_id", "embedding").dropDuplicates(["vec_id"]), "queries")
    shards = graphs.count()
    blocks = max(1, math.ceil(queries.count() / cfg.query_rows))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1))))
    offered = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = asked.groupBy("shard", "block").cogroup(offered.groupBy("shard", "block")).applyInPandas(
        _searcher(cfg), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cfg.top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest_neighbours(rows: DataFrame, is_query: Column, cfg: HnswConfig = HnswConfig()) -> DataFrame:
    """The ``top`` nearest of all other rows for each row where ``is_query`` holds."""
    good = stored(flagged(rows), "vectors").where("ok")
    return search(good.where(is_query), build_index(good, cfg), cfg)
