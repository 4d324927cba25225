"""Line dedup against plain Python."""
from collections import Counter, defaultdict

from latticeguard.llm.linededup import drop_boilerplate

SCHEMA = "doc_id long, source string, text string, site string, kept_lines string"


def brute(rows, ratio, min_pages):
    pages, seen = defaultdict(set), defaultdict(set)
    for _, host, text, *_ in rows:
        if host and text is not None:
            pages[host].add(text)
            for line in text.split("\n"):
                seen[host, line.strip(" \t\r\x0b\x0c")].add(text)
    bad = {k for k, texts in seen.items() if k[1] and len(texts) >= min_pages and len(texts) > ratio * len(pages[k[0]])}
    out = Counter()
    for i, host, text, *_ in rows:
        lines = None if text is None else [x for x in text.split("\n") if (host, x.strip(" \t\r\x0b\x0c")) not in bad]
        out[i, None if lines is None else "\n".join(lines)] += 1
    return out


def rows():
    out = [(i, "a" if i % 3 else "b", f"menu \nbody {i}\n\nfooter\nx{i % 7}", "s", "k") for i in range(60)]
    out += [(100, None, "menu\nq", "s", "k"), (101, "", "menu", "s", "k"), (102, "a", None, "s", "k"), (103, "a", "", "s", "k"),
            (104, "a", "\n\n", "s", "k"), (105, "tiny", "menu\nfooter", None, None), (106, "a", "menu\n" + "long line " * 20_000, "s", "k")]
    out += [(200 + i, "c", "same page\nwhole", "s", "k") for i in range(50)]  # copies are one page
    return out + [(7, "a", "menu\nbody 7", "s", "k")] * 2


def test_equals_brute_force(spark):
    df = spark.createDataFrame(rows(), SCHEMA).repartition(5)
    got = drop_boilerplate(df, ratio=0.1, min_pages=4, dropped="n_dropped")
    assert got.columns == [*df.columns, "n_dropped"]
    got = got.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == brute(rows(), 0.1, 4)
    by = {r["doc_id"]: r for r in got}
    assert by[200]["text"] == "same page\nwhole" and by[200]["n_dropped"] == 0
    assert by[1]["text"] == "body 1\n" and by[1]["n_dropped"] == 3


def test_ratio_is_exclusive_and_empty_table(spark):
    two = [(i, "h", f"shared\nown {i}" if i < 5 else f"own {i}") for i in range(10)]
    df = spark.createDataFrame(two, "doc_id long, source string, text string")
    assert all(r["text"].startswith("shared") for r in drop_boilerplate(df, ratio=0.5).where("doc_id < 5").collect())
    assert not any("shared" in r["text"] for r in drop_boilerplate(df, ratio=0.49).collect())
    assert drop_boilerplate(df.limit(0)).collect() == []
