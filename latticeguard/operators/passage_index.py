"""Impact-ordered inverted index over passages, with exact top-k by bounds.

The corpus is tokenized once, when the index is written; any number of queries is answered from it.
A posting's impact is its term count over its chunk's norm, so the cosine of a query and a chunk is
the sum, over shared terms, of the query's weight times the impact. Postings are kept by term and
layer, a quarter octave of impact: a block of chunks writes one list per term, in the order of the layers,
with the number of postings and the largest impact of each. A search meets lists, not postings.

A search takes two steps, all joins on terms or chunks. First the cells of the largest possible
contribution give some chunks per query; the k-th best of their exact scores is a floor. Then terms
whose largest contributions together stay under a share of the floor are set aside: a chunk with no
other term can't be among the k best. The other terms' postings are added up, block by block, and a chunk stays
a candidate if its sum and what the terms set aside could add reach the floor. Candidates are scored exactly, from
the counts in the lists of all terms of their query.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, release

#: Layers an octave of impact is cut into.
LAYERS = 4
#: Postings taken for the floor, times k; larger cells are left to the second step.
SEEDS = 40
SEED_CELL = 65_536
#: Share of the floor that the terms set aside may reach together: more reads fewer postings, but scores more chunks
#: (sf0.1, 200 queries: 675,254 pairs to score at a quarter, 25,178 at 0.02, with as long a sum before).
ASIDE = 0.02
#: Chunks whose postings make one block, and most chunks in an Arrow batch while an index is written.
BLOCK = 2048
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows (query, term) up to which the queries go to every task; more of them meet postings and chunks' terms by joins.
TERMS_TO_TASKS = 1_000_000
#: Scores are rounded to 9 digits before they are ranked; bounds leave more room than that.
_ROOM = 1e-8


@F.arrow_udf(T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("c", T.LongType())])))
def _term_counts(tokens: pa.Array) -> pa.Array:
    """Each row's distinct tokens with their counts; a chunk is counted where it is read, nothing is shuffled."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False), np.int64)
    words = tokens.flatten().dictionary_encode(null_encoding="encode")
    size = max(1, len(words.dictionary))
    places = np.repeat(np.arange(len(tokens)), lengths) * size + words.indices.to_numpy(zero_copy_only=False)
    pairs, counts = np.unique(places, return_counts=True)
    starts = np.searchsorted(pairs, np.arange(len(tokens) + 1) * size).astype(np.int32)
    held = pa.StructArray.from_arrays([words.dictionary.take(pa.array(pairs % size)), pa.array(counts, pa.int64())], names=["term", "c"])
    return pa.ListArray.from_arrays(pa.array(starts), held)


_HEAD = pa.struct([("layer", pa.int32()), ("start", pa.int32()), ("n", pa.int32()), ("top", pa.float64())])
LISTS = ("block long, term string, heads array<struct<layer: int, start: int, n: int, top: double>>, "
         "uids array<long>, impacts array<double>, counts array<int>")


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (uid, norm, terms), a block at a time, as one list per term: in the order of layer and uid."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            if (made := _block(batch.slice(at, BLOCK))) is not None:
                yield made


def _block(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    terms = batch.column("terms")
    lengths = np.asarray(pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False), np.int64)
    found = terms.flatten()
    if not len(found):
        return None
    words = found.field("term").dictionary_encode(null_encoding="encode")
    ranks = np.empty(len(words.dictionary), np.int64)
    ranks[pc.sort_indices(words.dictionary).to_numpy()] = np.arange(len(ranks))
    owner = np.repeat(np.arange(len(terms)), lengths)
    counts = found.field("c").to_numpy()
    impact = counts / batch.column("norm").to_numpy(zero_copy_only=False)[owner]
    layer = np.floor(-LAYERS * np.log2(impact) + 1e-9).astype(np.int64)
    word = words.indices.to_numpy(zero_copy_only=False)
    uid = batch.column("uid").to_numpy()[owner]
    order = np.lexsort((uid, layer, ranks[word]))
    word, layer, impact = word[order], layer[order], impact[order]
    new = word[1:] != word[:-1]
    starts = np.flatnonzero(np.concatenate(([True], new)))  # of the lists
    cells = np.flatnonzero(np.concatenate(([True], new | (layer[1:] != layer[:-1]))))
    ends = pa.array(np.append(starts, len(word)).astype(np.int32))
    list_of = np.searchsorted(starts, cells, "right") - 1
    heads = pa.StructArray.from_arrays([
        pa.array(layer[cells], pa.int32()), pa.array(cells - starts[list_of], pa.int32()),
        pa.array(np.diff(np.append(cells, len(word))), pa.int32()), pa.array(np.maximum.reduceat(impact, cells))], fields=list(_HEAD))
    held = (pa.array(uid[order]), pa.array(impact), pa.array(counts[order], pa.int32()))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(starts), uid.min())), words.dictionary.take(pa.array(word[starts])),
         pa.ListArray.from_arrays(pa.array(np.searchsorted(cells, np.append(starts, len(word))).astype(np.int32)), heads),
         *(pa.ListArray.from_arrays(ends, h) for h in held)],
        names=["block", "term", "heads", "uids", "impacts", "counts"])


def _met(rows: list, limits: list):
    """A function from a block's lists (term, uids, impacts, counts) to its candidates (query_id, uid, dot), for queries given as rows
    (query_id, term, w, qc, aside) and their limits (query_id, floor, rest)."""
    words = sorted({r["term"] for r in rows})
    place = {w: i for i, w in enumerate(words)}
    of = {r["query_id"]: ([], r["floor"] - r["rest"] - _ROOM) for r in limits}
    for r in rows:
        of[r["query_id"]][0].append((place[r["term"]], r["w"], r["qc"], r["aside"]))

    def candidates(table: pa.Table) -> pa.Table:
        term = pc.index_in(table.column("term").combine_chunks(), pa.array(words, pa.string())).to_numpy(zero_copy_only=False)
        uids, impact, counts = (table.column(c).combine_chunks() for c in ("uids", "impacts", "counts"))
        each = np.repeat(term, np.asarray(pc.list_value_length(uids).to_numpy(zero_copy_only=False), np.int64))
        order = np.argsort(each, kind="stable")
        uids, local = np.unique(uids.flatten().to_numpy()[order], return_inverse=True)
        impact, counts = impact.flatten().to_numpy()[order], counts.flatten().to_numpy()[order].astype(np.int64)
        bounds = np.searchsorted(each[order], np.arange(len(words) + 1)).tolist()
        out = []
        for query, (mine, least) in of.items():
            part = np.zeros(len(uids))  # a term has one posting of a chunk
            for t, w, _, aside in mine:
                if not aside and bounds[t] < bounds[t + 1]:
                    at = slice(bounds[t], bounds[t + 1])
                    part[local[at]] += w * impact[at]
            hits = np.flatnonzero((part > 0) & (part >= least))
            if hits.size:
                dot = np.zeros(len(uids), np.int64)
                for t, _, qc, _ in mine:
                    at = slice(bounds[t], bounds[t + 1])
                    dot[local[at]] += qc * counts[at]
                out.append((np.full(hits.size, query, np.int64), uids[hits], dot[hits]))
        columns = zip(*out, strict=True) if out else ([], [], [])
        return pa.table([pa.array(np.concatenate([np.empty(0, np.int64), *c])) for c in columns], names=["query_id", "uid", "dot"])

    return candidates


def _dots(rows: list):
    """A column function (query_id, terms) -> dot of the query's and the chunk's counts, for queries given as rows
    (query_id, term, qc): a pair costs its chunk's terms, however long the query is."""
    words = sorted({r["term"] for r in rows})
    place = {w: i for i, w in enumerate(words)}
    qids = np.unique(np.array([r["query_id"] for r in rows], np.int64))
    cells = np.searchsorted(qids, np.array([r["query_id"] for r in rows], np.int64)) * len(words) + np.array(
        [place[r["term"]] for r in rows], np.int64)
    order = np.argsort(cells)
    cells, counts = cells[order], np.array([r["qc"] for r in rows], np.int64)[order]

    @F.arrow_udf(T.LongType())
    def dots(query_id: pa.Array, terms: pa.Array) -> pa.Array:
        lengths = np.asarray(pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False), np.int64)
        found = terms.flatten()
        if not len(found):
            return pa.array(np.zeros(len(terms), np.int64))
        word = pc.fill_null(pc.index_in(found.field("term"), pa.array(words, pa.string())), -1).to_numpy(zero_copy_only=False)
        known = np.flatnonzero(word >= 0)
        pair = np.repeat(np.arange(len(terms)), lengths)[known]
        wanted = np.searchsorted(qids, query_id.to_numpy())[pair] * len(words) + word[known]
        at = np.minimum(np.searchsorted(cells, wanted), len(cells) - 1)
        hit = cells[at] == wanted
        out = np.zeros(len(terms), np.int64)
        np.add.at(out, pair[hit], counts[at[hit]] * found.field("c").to_numpy()[known[hit]])
        return pa.array(out)

    return dots


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most BLOCK chunks: a chunk has hundreds of terms, and both sides hold a batch."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(int(before), BLOCK) if int(before) > 0 else BLOCK))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def _few(rows: DataFrame) -> list:
    """The rows, if there are at most TERMS_TO_TASKS; none otherwise."""
    found = rows.limit(TERMS_TO_TASKS + 1).collect()
    return found if len(found) <= TERMS_TO_TASKS else []


@dataclass
class PassageIndex:
    """chunks: uid, doc_id, chunk_no, source, norm, terms; lists: block, term, heads (layer, start, n, top), and of
    each posting, in the order of layer and uid, uids, impacts, counts."""

    chunks: DataFrame
    lists: DataFrame

    @property
    def postings(self) -> DataFrame:
        """(term, uid, impact, c), one row per posting."""
        return self.lists.select("term", F.inline(F.arrays_zip(
            F.col("uids").alias("uid"), F.col("impacts").alias("impact"), F.col("counts").alias("c"))))

    @classmethod
    def build(cls, chunk_emb: DataFrame, root: str) -> PassageIndex:
        """Write an index of chunks (doc_id, chunk_no, source, tokens) under a shared folder. A row is a chunk of its
        own, also if it is repeated; one without tokens has no posting."""
        spark = chunk_emb.sparkSession
        rows = chunk_emb.select("doc_id", "chunk_no", "source", "tokens").withColumn("uid", F.monotonically_increasing_id())
        # no filter on the tokens or terms: it would be pushed below, and every text cut or counted twice
        held = rows.withColumn("terms", _term_counts("tokens")).drop("tokens")
        squares = F.aggregate("terms", F.lit(0).cast("long"), lambda total, t: total + t["c"] * t["c"])
        with _small_batches(spark):
            held.withColumn("norm", F.sqrt(squares.cast("double"))).write.parquet(f"{root}/chunks")
            # the ids hold from here on, as they are written; a chunk's postings stay where the chunk is read
            spark.read.parquet(f"{root}/chunks").select("uid", "norm", "terms").mapInArrow(
                _lists, LISTS).write.parquet(f"{root}/lists")
        return cls.open(spark, root)

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> PassageIndex:
        return cls(*(spark.read.parquet(f"{root}/{t}") for t in ("chunks", "lists")))

    # --- searching ------------------------------------------------------------------

    def _scored(self, pairs: DataFrame, queries: DataFrame) -> DataFrame:
        """(query_id, uid, doc_id, chunk_no, source, score) of pairs (query_id, uid), by their dot if they have one, or
        from whole chunks: a pair costs its chunk's terms, however long the query is."""
        held = ("query_id", "uid", "doc_id", "chunk_no", "source", "norm")
        found = pairs.join(self.chunks, "uid")
        norms = queries.groupBy("query_id").agg(F.max("qnorm").alias("qnorm"))
        if "dot" in pairs.columns:
            dots = found.select(*held, "dot").join(norms, "query_id")
        elif rows := _few(queries.select("query_id", "term", "qc")):
            dots = found.select(*held, _dots(rows)("query_id", "terms").alias("dot")).join(norms, "query_id")
        else:
            found = found.select(*held, F.explode("terms").alias("t")).select(*held, "t.term", "t.c")
            dots = found.join(queries, ["query_id", "term"]).groupBy(*held, "qnorm").agg(F.sum(F.col("c") * F.col("qc")).alias("dot"))
        score = F.round(F.col("dot").cast("double") / (F.col("norm") * F.col("qnorm")), 9)
        return dots.where("dot > 0").select("query_id", "uid", "doc_id", "chunk_no", "source", score.alias("score")).where("score > 0")

    def candidates(self, terms: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
        """(pairs (query_id, uid) that hold every k best chunk, queries (query_id, term, qc, qnorm)); both are written.
        Pairs also have their dot, unless the queries' terms are too many for every task."""
        norms = terms.groupBy("query_id").agg(F.sqrt(F.sum(F.col("c") * F.col("c")).cast("double")).alias("qnorm"))
        queries = materialize(terms.join(norms, "query_id").select("query_id", "term", F.col("c").alias("qc"), "qnorm"), "search-queries")
        heads = self.lists.select("term", "heads").join(queries.select("term").distinct(), "term", "left_semi").select(
            "term", F.inline("heads")).groupBy("term", "layer").agg(F.sum("n").alias("n"), F.max("top").alias("top"))
        cells = materialize(
            queries.withColumn("w", F.col("qc") / F.col("qnorm")).join(heads, "term").select(
                "query_id", "term", "qc", "w", "layer", "n", (F.col("w") * F.col("top")).alias("bound")), "search-cells")
        order = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "term", "layer")
        first = cells.where(F.col("n") <= SEED_CELL).withColumn("before", F.coalesce(
            F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).where(F.col("before") < SEEDS * k)
        # of the last cell, which may be large, only as many postings as are still wanted: any floor is a valid one
        taken = Window.partitionBy("query_id").orderBy(F.col("bound").desc(), "term", "layer", "uid")
        head = F.filter("heads", lambda h: h["layer"] == F.col("layer"))
        seeds = materialize(first.select("query_id", "term", "layer", "bound").join(self.lists.select("term", "heads", "uids"), "term").select(
            "query_id", "term", "layer", "bound", "uids", F.explode(head).alias("h")).select(
            "query_id", "term", "layer", "bound",
            F.slice("uids", F.col("h.start") + 1, F.least("h.n", F.lit(SEEDS * k))).alias("uids")).select(
            "query_id", "term", "layer", "bound", F.explode("uids").alias("uid")).withColumn(
            "i", F.row_number().over(taken)).where(F.col("i") <= SEEDS * k).select("query_id", "uid").distinct(), "search-seeds")
        best = Window.partitionBy("query_id").orderBy(F.col("score").desc())
        floor = self._scored(seeds, queries).withColumn("i", F.row_number().over(best)).where(F.col("i") == k).select(
            "query_id", F.col("score").alias("floor"))
        rising = Window.partitionBy("query_id").orderBy("ub", "term").rowsBetween(Window.unboundedPreceding, 0)
        most = cells.groupBy("query_id", "term", "w", "qc").agg(F.max("bound").alias("ub")).join(floor, "query_id", "left").withColumn(
            "floor", F.coalesce("floor", F.lit(0.0))).withColumn("upto", F.sum("ub").over(rising))
        most = materialize(most.withColumn("aside", F.col("upto") < ASIDE * F.col("floor") - _ROOM), "search-terms")
        limits = most.groupBy("query_id").agg(F.max("floor").alias("floor"), F.sum(F.when(F.col("aside"), F.col("ub")).otherwise(0.0)).alias("rest"))
        if rows := _few(most.select("query_id", "term", "w", "qc", "aside")):
            # a block is one group, so its sums are whole where they are made
            lists = self.lists.select("block", "term", "uids", "impacts", "counts").join(most.select("term").distinct(), "term", "left_semi")
            found = lists.groupBy("block").applyInArrow(_met(rows, limits.collect()), "query_id long, uid long, dot long")
        else:
            sums = most.where("NOT aside").select("query_id", "term", "w").join(self.postings, "term").groupBy("query_id", "uid").agg(F.sum(F.col("w") * F.col("impact")).alias("part"))
            found = sums.join(limits, "query_id").where(F.col("part") + F.col("rest") >= F.col("floor") - _ROOM).select("query_id", "uid")
        pairs = materialize(found, "search-pairs")
        for used in (cells, seeds, most):
            release(used)
        return pairs, queries

    def search(self, terms: DataFrame, k: int = 5) -> DataFrame:
        """Exact top-k chunks per query by cosine of term counts (score > 0 only): (query_id, rank, doc_id, chunk_no,
        source, score); ties by doc_id, chunk_no. `terms` has query_id, term and its count c."""
        pairs, queries = self.candidates(terms, k)
        best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc(), F.col("chunk_no").asc(), "uid")
        return self._scored(pairs, queries).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
            "query_id", "rank", "doc_id", "chunk_no", "source", "score")
