"""Near-duplicate vectors by product quantisation: inverted lists of residual codes, table-lookup distances, exact rerank.

1. Equal vectors count as one with a multiplicity. Coarse centres and codebooks are trained on a bounded sample (the vectors
   with the smallest hash, ``train_values`` numbers in all); every vector is indexed.
2. A vector goes to the list of its nearest centre with the codes of its residual (a codebook for each part of the
   dimensions) and the length of what the codes lose. It visits its ``probes`` nearest lists.
3. Lists meet their visitors in blocks of about ``block`` rows on each side, so a list that holds a third of all vectors is many
   tasks. In a block, asymmetric distances come from lookup tables of the visitor; those that could be within the limit
   given the codes' loss are reranked by cosine in double precision. The loss is exact, so the codes lose no link; a link is
   missed only where neither vector visits the other's list.
4. A block returns link counts and a spanning forest of its links, never the pairs.

A pair that could meet in two lists counts in one. Null, zero, ragged and non-finite vectors link with nothing. Rows that
repeat a vector are links of each other. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowjudge.llm.common import components, roots, stored
from rowjudge.llm.vectors import flagged, kmeans, nearest


@dataclass(frozen=True)
class PqConfig:
    least: float = 0.95
    probes: int = 8
    parts: int = 8
    codes: int = 256
    train_values: int = 1 << 20
    rounds: int = 10
    block: int = 1024
    seed: int = 5


@dataclass(frozen=True)
class Codebooks:
    centre: np.ndarray  # lists x dimensions
    edges: list[int]  # of the parts
    books: list[np.ndarray]  # for each part: codes x its dimensions


def train(distinct: DataFrame, cfg: PqConfig) -> Codebooks | None:
    n, size = distinct.count(), distinct.select(F.size("embedding")).first()
    if not n:
        return None
    rows = min(n, max(256, cfg.train_values // size[0]))
    picked = distinct.orderBy("k1", "k2").limit(rows).select("embedding").toPandas()  # the bounded sample
    x = np.stack(picked["embedding"].to_numpy()).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = max(1, min(int(math.sqrt(n) / 2), rows // 32))
    centre = kmeans(x, lists, cfg.rounds, cfg.seed)
    rest = x - centre[nearest(x, centre, 1)[:, 0]]
    edges = [round(i * x.shape[1] / cfg.parts) for i in range(cfg.parts + 1)]
    books = [kmeans(rest[:, a:b], cfg.codes, cfg.rounds, cfg.seed) for a, b in zip(edges, edges[1:]) if b > a]
    return Codebooks(centre, sorted(set(edges)), books)


def encode(distinct: DataFrame, model: Codebooks, cfg: PqConfig) -> DataFrame:
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["embedding"].to_numpy())
            x = x / np.linalg.norm(x, axis=1, keepdims=True)
            probes = nearest(x, model.centre, cfg.probes)
            rest = x - model.centre[probes[:, 0]]
            code, back = np.zeros((len(x), len(model.books)), np.uint8), np.zeros_like(x)
            for i, (a, b) in enumerate(zip(model.edges, model.edges[1:])):
                code[:, i] = nearest(rest[:, a:b], model.books[i], 1)[:, 0]
                back[:, a:b] = model.books[i][code[:, i]]
            yield pd.DataFrame({"rep": pdf["rep"], "copies": pdf["copies"], "home": probes[:, 0], "probes": list(probes.astype(np.int32)),
                                "code": [c.tobytes() for c in code], "loss": np.linalg.norm(rest - back, axis=1),
                                "unit": [v.tobytes() for v in x]})

    return distinct.mapInPandas(run, "rep long, copies long, home int, probes array<int>, code binary, loss double, unit binary")


def _matcher(model: Codebooks, cfg: PqConfig):
    reach = math.sqrt(2 - 2 * cfg.least) + 1e-9

    def match(key, pdf: pd.DataFrame) -> pd.DataFrame:
        here = key[0]
        item, visitor = pdf[pdf["role"] == 0], pdf[pdf["role"] == 1]
        if not len(item) or not len(visitor):
            return pd.DataFrame({"a": [], "b": [], "links": []})
        y, x = (np.stack([np.frombuffer(v) for v in side["unit"]]) for side in (item, visitor))
        code = np.stack([np.frombuffer(c, np.uint8) for c in item["code"]])
        rest = x - model.centre[here]
        far = np.zeros((len(x), len(y)))
        for i, (a, b) in enumerate(zip(model.edges, model.edges[1:])):
            part, book = rest[:, a:b], model.books[i]
            table = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)
            far += table[:, code[:, i]]
        near = np.sqrt(np.maximum(far, 0)) - item["loss"].to_numpy() <= reach
        xid, yid = visitor["rep"].to_numpy(), item["rep"].to_numpy()
        xhome = visitor["home"].to_numpy()
        # each pair in one place: within a list by id, else in the smaller of the lists where both orders can meet
        own = xhome == here
        seen = np.stack(item["probes"].to_numpy())
        back = (seen[None, :, :] == xhome[:, None, None]).any(2)
        near &= np.where(own[:, None], xid[:, None] > yid[None, :], ~back | (here < xhome)[:, None])
        i, j = np.nonzero(near)
        keep = np.zeros(len(i), bool)
        for at in range(0, len(i), 65536):
            p, q = i[at: at + 65536], j[at: at + 65536]
            keep[at: at + 65536] = np.einsum("ij,ij->i", x[p], y[q]) >= cfg.least
        i, j = i[keep], j[keep]
        xm, ym = visitor["copies"].to_numpy(), item["copies"].to_numpy()
        nodes, root = roots(xid[i], yid[j])
        ids = np.concatenate([xid, yid])
        links = np.concatenate([np.bincount(i, ym[j], len(x)), np.bincount(j, xm[i], len(y))]).astype(np.int64)
        got = links > 0
        return pd.DataFrame({"a": np.concatenate([nodes, ids[got]]), "b": np.concatenate([root, ids[got]]),
                             "links": np.concatenate([np.zeros(len(nodes), np.int64), links[got]])})

    return match


def near_duplicates(rows: DataFrame, cfg: PqConfig = PqConfig()) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    every_row = stored(flagged(rows), "vectors")
    good = every_row.where("ok")
    distinct = good.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    distinct = stored(distinct, "distinct")
    model = train(distinct, cfg)
    none = F.lit(0).cast("long")
    if model is None:
        return every_row.select("vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    coded = stored(encode(distinct, model, cfg), "codes")
    items = {r["home"]: r["n"] for r in coded.groupBy("home").agg(F.count("*").alias("n")).collect()}  # one row a list
    visits = coded.select("*", F.explode("probes").alias("list"))
    guests = {r["list"]: r["n"] for r in visits.groupBy("list").agg(F.count("*").alias("n")).collect()}
    lists = range(len(model.centre))
    item_blocks = F.element_at(F.array(*[F.lit(-(-items.get(i, 0) // cfg.block) or 1) for i in lists]), F.col("list") + 1)
    guest_blocks = F.element_at(F.array(*[F.lit(-(-guests.get(i, 0) // cfg.block) or 1) for i in lists]), F.col("list") + 1)
    deal = lambda n: F.pmod(F.xxhash64("rep"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    columns = ["list", "role", "ib", "gb", "rep", "copies", "home", "probes", "code", "loss", "unit"]
    left = coded.withColumn("list", F.col("home")).withColumn("role", F.lit(0)).withColumn("ib", deal(item_blocks)).withColumn("gb", every(guest_blocks))
    right = visits.withColumn("role", F.lit(1)).withColumn("gb", deal(guest_blocks)).withColumn("ib", every(item_blocks))
    met = left.select(*columns).union(right.select(*columns)).groupBy("list", "ib", "gb")
    found = stored(met.applyInPandas(_matcher(model, cfg), "a long, b long, links long"), "links")
    counts = found.where("links > 0").groupBy("a").agg(F.sum("links").alias("links"))
    label = components(found.where("links = 0").select("a", "b"))
    reps = distinct.select("k1", "k2", "rep", "copies").join(counts, F.col("rep") == F.col("a"), "left").drop("a")
    reps = reps.join(label, F.col("rep") == F.col("node"), "left").select(
        "k1", "k2", (F.col("copies") - 1 + F.coalesce("links", none)).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id"))
    linked = good.select("vec_id", "k1", "k2").join(reps, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    bad = every_row.where("NOT ok").select("vec_id", none.alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(bad).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
