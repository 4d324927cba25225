"""Chunking, vector top-k, rule hits and keyword search.

* chunks: whitespace words, windows of 500 with 50 overlap, built with
  split/sequence/slice/explode -- every word of every text is covered;
* top-k: query vectors are attached to each row with an explode of a literal array
  (no join), a block of queries at a time; each task keeps k rows per query before
  the shuffle (partial window limit), so no task ranks a whole table;
* rule hits: lines by posexplode, rules as literal regexes, every match a finding row;
* chunk embeddings (R13): bag-of-words term-count vectors -- Unicode letters and
  digits, the norm by a run-length pass over the sorted tokens, all in-row;
* retrieval (R14): cosine of term-count vectors between query texts and every chunk,
  a block of queries at a time. Scoring turns an Arrow batch into sparse term counts
  and adds up postings of the block's terms in arrays; each task keeps the k best
  chunks per query, and only those are shuffled for the final exact top-k.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_WORDS = 500
CHUNK_OVERLAP = 50
#: Queries scored in one pass over the data; more queries take more passes.
QUERY_BLOCK = 1024
TOKEN_RX = r"[\p{L}\p{N}]+"

# Fixed values (ours): weak-crypto rules over text lines -- (rule_id, regex, inferred algorithm).
RULES = (
    ("hardcoded-key", r'token\s*=\s*"[0-9a-fA-F]{40}"', None),
    ("rsa-1024-keygen", r"(?i)rsa[-_ ]?1024", "RSA"),
    ("des-cipher", r"\bDES\b", "DES"),
    ("md5-digest", r"(?i)\bmd5\b", "MD5"),
)


def chunk_words(rows: DataFrame, keep: tuple[str, ...], text: str, size: int = CHUNK_WORDS,
                overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """Windows over the words of `text`: (keep..., chunk_no, start_word, n_words, chunk_text)."""
    step = size - overlap
    words = F.split(F.trim(F.col(text)), r"\s+")
    d = rows.select(*keep, words.alias("w"))
    last = F.greatest(F.lit(0), F.size("w") - F.lit(overlap + 1))
    d = d.select(*keep, "w", F.posexplode(F.sequence(F.lit(0), last, F.lit(step))).alias("chunk_no", "start_word"))
    piece = F.slice(F.col("w"), F.col("start_word") + 1, F.lit(size))
    return d.select(*keep, "chunk_no", "start_word", F.size(piece).alias("n_words"),
                    F.array_join(piece, " ").alias("chunk_text"))


def chunks(documents: DataFrame, size: int = CHUNK_WORDS, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """(doc_id, chunk_no, start_word, n_words, chunk_text, source, lang)."""
    d = chunk_words(documents, ("doc_id", "source", "lang"), "text", size, overlap)
    return d.select("doc_id", "chunk_no", "start_word", "n_words", "chunk_text", "source", "lang")


def page_sections(pages: DataFrame) -> DataFrame:
    """(page_id, url, title, section_no, section, text): an HTML page's article, cut at its bold headings.
    Section 0 runs from the h1; tags become blanks; a section without text is left out."""
    html = F.col("html")
    article = F.regexp_extract(html, r"(?s)<article>(.*?)</article>", 1)
    d = pages.select("page_id", "url", F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1).alias("title"),
                     F.posexplode(F.split(article, "<p><b>")).alias("section_no", "raw"))
    heading = F.when(F.col("section_no") == 0, F.regexp_extract("raw", "<h1>([^<]*)</h1>", 1)).otherwise(
        F.regexp_extract("raw", "^([^<]*)", 1))
    text = F.trim(F.regexp_replace(F.regexp_replace("raw", "<[^>]*>", " "), "[ \\t\\n\\r]+", " "))
    return d.select("page_id", "url", "title", "section_no", F.trim(heading).alias("section"), text.alias("text")) \
        .where(F.col("text") != "")


def dot(a: Column, b: Column) -> Column:
    """sum of products in double precision (left fold, in element order)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double"))
                                         * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda acc, x: acc + x))


def class_centroid_queries(embeddings: DataFrame) -> list[tuple[int, list[float]]]:
    """Query vectors = mean embedding of each label class (computed by Spark, one row per class)."""
    dim = embeddings.select(F.size("embedding")).first()[0]
    rows = embeddings.groupBy("label").agg(
        *[F.avg(F.col("embedding")[i].cast("double")).alias(f"c{i}") for i in range(dim)]).collect()
    return sorted((int(r["label"]), [float(r[f"c{i}"]) for i in range(dim)]) for r in rows)


def topk(embeddings: DataFrame, queries: list[tuple[int, list[float]]], k: int = 5, metric: str = "cosine",
         block: int = QUERY_BLOCK) -> DataFrame:
    """Exact top-k per query: (query_id, rank, vec_id, label, score); one pass per block of queries."""
    if metric not in ("cosine", "l2"):
        raise ValueError("metric must be cosine or l2")
    cosine = metric == "cosine"
    rows = embeddings.select("vec_id", "label", "embedding", norm(F.col("embedding")).alias("n"))
    order = [F.col("score").desc() if cosine else F.col("score").asc(), F.col("vec_id").asc()]
    best = Window.partitionBy("query_id").orderBy(*order)
    out = None
    for at in range(0, max(1, len(queries)), block):
        qarr = F.array(*[F.struct(F.lit(qid).alias("qid"), F.array(*[F.lit(float(v)) for v in vec]).alias("qv"),
                                  F.lit(math.sqrt(sum(v * v for v in vec))).alias("qn"))
                         for qid, vec in queries[at:at + block]])
        d = rows.select("vec_id", "label", "embedding", "n", F.explode(qarr).alias("q"))
        score = dot(F.col("embedding"), F.col("q.qv")) / (F.col("n") * F.col("q.qn")) if cosine else l2(
            F.col("embedding"), F.col("q.qv"))
        d = d.select(F.col("q.qid").alias("query_id"), "vec_id", "label", score.alias("score"))
        d = d.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
            .select("query_id", "rank", "vec_id", "label", "score")
        out = d if out is None else out.unionByName(d)
    return out


def rule_hits(documents: DataFrame, rules=RULES) -> DataFrame:
    """Every match of every rule as a finding row:
    (doc_id, path, line_no, rule_id, match_no, snippet, algorithm)."""
    lines = documents.select(
        "doc_id", F.concat_ws("/", F.col("source"), F.col("doc_id").cast("string")).alias("path"),
        F.posexplode(F.split(F.col("text"), "\n")).alias("pos", "line"))
    hits = F.array(*[F.struct(F.lit(rid).alias("rule_id"), F.regexp_extract_all("line", F.lit(rx), F.lit(0)).alias("found"),
                              F.lit(alg).cast("string").alias("algorithm")) for rid, rx, alg in rules])
    rows = lines.select("doc_id", "path", (F.col("pos") + 1).alias("line_no"), F.explode(hits).alias("h")) \
        .where(F.size("h.found") > 0)
    return rows.select("doc_id", "path", "line_no", "h.rule_id", "h.algorithm",
                       F.posexplode("h.found").alias("match_pos", "snippet")).select(
        "doc_id", "path", "line_no", "rule_id", (F.col("match_pos") + 1).alias("match_no"), "snippet", "algorithm")


def searchable(findings: DataFrame, assets: DataFrame) -> DataFrame:
    """(kind, id, asset_id, hay): the text of findings (algorithm, hostname, repo, detail) and assets (hostname,
    repo, data asset, criticality, zone), in lower case."""
    def hay(*parts: Column) -> Column:
        return F.lower(F.concat_ws(" ", *parts)).alias("hay")

    return findings.select(
        F.lit("finding").alias("kind"), F.col("finding_id").alias("id"), "asset_id",
        hay(F.col("algorithm"), F.col("asset_hint.hostname"), F.col("asset_hint.repo"),
            F.array_join(F.map_values(F.col("detail")), " "))).unionByName(
        assets.select(F.lit("asset").alias("kind"), F.col("asset_id").cast("string").alias("id"), "asset_id",
                      hay(F.col("hostname"), F.col("repo"), F.col("data_asset"), F.col("criticality"),
                          F.col("network_zone"))))


def keyword_search(findings: DataFrame, assets: DataFrame, terms: tuple[str, ...]) -> DataFrame:
    """Findings and assets that contain a term, case-insensitively, by a scan: (term, kind, id, asset_id)."""
    d = searchable(findings, assets).select(
        "kind", "id", "asset_id", "hay", F.explode(F.array(*[F.lit(t.lower()) for t in terms])).alias("term"))
    return d.where(F.instr(F.col("hay"), F.col("term")) > 0).select("term", "kind", "id", "asset_id")


def latest_per_key(history: DataFrame, key: str, ts: str, cols: list[str]) -> DataFrame:
    """Newest row per key, of rows of one time the largest (a partial aggregation)."""
    return history.groupBy(key).agg(F.max(F.struct(ts, *cols)).alias("_l")).select(key, *(f"_l.{c}" for c in cols), f"_l.{ts}")


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits of any script, in text order."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN_RX), 0), lambda t: F.lower(t))


def sum_sq_counts(tok: Column) -> Column:
    """sum over distinct terms of count^2, by one run-length pass over the sorted tokens."""
    init = F.struct(F.lit(None).cast("string").alias("p"), F.lit(0).cast("long").alias("r"),
                    F.lit(0).cast("long").alias("ss"))

    def step(acc, t):
        return F.when(acc["p"] == t, F.struct(acc["p"].alias("p"), (acc["r"] + 1).alias("r"), acc["ss"].alias("ss"))) \
            .otherwise(F.struct(t.alias("p"), F.lit(1).cast("long").alias("r"),
                                (acc["ss"] + acc["r"] * acc["r"]).alias("ss")))

    return F.aggregate(F.array_sort(tok), init, step, lambda acc: acc["ss"] + acc["r"] * acc["r"])


def chunk_embeddings(chunk_df: DataFrame) -> DataFrame:
    """Term-count vector of every chunk: (doc_id, chunk_no, source, tokens, n_tokens, n_terms, norm)."""
    d = chunk_df.select("doc_id", "chunk_no", "source", tokens(F.col("chunk_text")).alias("tokens"))
    return d.select("doc_id", "chunk_no", "source", "tokens", F.size("tokens").alias("n_tokens"),
                    F.size(F.array_distinct("tokens")).alias("n_terms"),
                    F.sqrt(sum_sq_counts(F.col("tokens")).cast("double")).alias("norm"))


def query_terms(queries: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(query_id, term, c): term counts of each query text."""
    return queries.select(F.col(id_col).cast("long").alias("query_id"),
                          F.explode(tokens(F.col(text_col))).alias("term")) \
        .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("c"))


def _postings(rows: list, qids: list[int]):
    """(terms, offsets, slots, weights, norms): the postings of a block's terms, as flat arrays."""
    slot = {q: i for i, q in enumerate(qids)}
    rows = sorted(rows, key=lambda r: r["term"])
    terms, counts = np.unique(np.array([r["term"] for r in rows], dtype=object), return_counts=True)
    slots = np.array([slot[int(r["query_id"])] for r in rows], np.int64)
    weights = np.array([float(r["c"]) for r in rows])
    norms = np.sqrt(np.bincount(slots, weights * weights, len(qids)))
    return terms.tolist(), np.concatenate(([0], np.cumsum(counts))), slots, weights, norms


def _scores(tokens: pa.ListArray, index, n_queries: int) -> np.ndarray:
    """Cosine of every chunk of a slice with every query of a block, rounded to 9 digits (0: nothing shared)."""
    terms, offsets, slots, weights, norms = index
    lengths = np.asarray(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False), np.int64)
    words = tokens.flatten().dictionary_encode()
    owner = np.repeat(np.arange(len(tokens)), lengths)
    size = max(1, len(words.dictionary))
    pairs, counts = np.unique(owner * size + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
    chunk, word = pairs // size, pairs % size
    lengths2 = np.sqrt(np.bincount(chunk, counts.astype(float) ** 2, len(tokens)))
    if not len(words):
        return np.zeros((len(tokens), n_queries))
    term = pc.fill_null(pc.index_in(words.dictionary, pa.array(terms, pa.string())), -1).to_numpy(zero_copy_only=False)[word]
    known = term >= 0
    chunk, term, counts = chunk[known], term[known], counts[known]
    fan = offsets[term + 1] - offsets[term]
    place = np.repeat(offsets[term], fan) + np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
    cell = np.repeat(chunk, fan) * n_queries + slots[place]
    dots = np.bincount(cell, np.repeat(counts, fan) * weights[place], len(tokens) * n_queries).reshape(len(tokens), n_queries)
    return np.round(dots / np.maximum(lengths2[:, None] * norms[None, :], 1e-300), 9)


def _retrieve_block(chunk_emb: DataFrame, rows: list, k: int) -> DataFrame:
    qids = sorted({int(r["query_id"]) for r in rows})
    index = _postings(rows, qids)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in qids]
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNKS_AT_ONCE):
                part = batch.slice(at, CHUNKS_AT_ONCE)
                doc, chunk = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "chunk_no"))
                scores = _scores(part.column("tokens"), index, len(qids))
                for q in np.flatnonzero(scores.any(axis=0)):
                    mine = scores[:, q]
                    hits = np.flatnonzero(mine > (best[q][-1][0] if len(best[q]) == k else 0.0) - 1e-12)
                    hits = hits[mine[hits] > 0]
                    if not hits.size:
                        continue
                    hits = hits[np.lexsort((chunk[hits], doc[hits], -mine[hits]))][:k]
                    sources = part.column("source").take(pa.array(hits)).to_pylist()
                    merged = best[q] + [(float(mine[h]), int(doc[h]), int(chunk[h]), s)
                                        for h, s in zip(hits, sources, strict=True)]
                    best[q] = sorted(merged, key=lambda r: (-r[0], r[1], r[2]))[:k]
        out = [(qid, d, c, s, score) for qid, mine in zip(qids, best, strict=True) for score, d, c, s in mine]
        if out:
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.string()), pa.array(cols[4], pa.float64())],
                names=["query_id", "doc_id", "chunk_no", "source", "score"])

    return chunk_emb.select("doc_id", "chunk_no", "source", "tokens").mapInArrow(
        kernel, "query_id long, doc_id long, chunk_no int, source string, score double")


#: Chunks scored together (times the queries of a block: the size of the score matrix).
CHUNKS_AT_ONCE = 512


def retrieve(chunk_emb: DataFrame, terms: DataFrame, k: int = 5, block: int = QUERY_BLOCK) -> DataFrame:
    """Exact top-k chunks per query by cosine of term-count vectors (score > 0 only):
    (query_id, rank, doc_id, chunk_no, source, score); ties by doc_id, chunk_no.

    `chunk_emb` needs (doc_id, chunk_no, source, tokens). Queries are dealt into blocks by a
    hash of their id; a block's terms go to every task, and each block is one pass.
    """
    blocks = max(1, -(-terms.select("query_id").distinct().count() // block))
    dealt = terms.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    found = None
    for b in range(blocks):
        rows = dealt.where(F.col("block") == b).select("query_id", "term", "c").collect()
        if rows:
            part = _retrieve_block(chunk_emb, rows, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = chunk_emb.limit(0).select(F.lit(0).cast("long").alias("query_id"), "doc_id", "chunk_no", "source",
                                          F.lit(0.0).alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("doc_id").asc(), F.col("chunk_no").asc())
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "doc_id", "chunk_no", "source", "score")
