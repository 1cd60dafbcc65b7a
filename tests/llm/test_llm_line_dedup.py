from collections import Counter

from llm_cases import odd_texts, table

from faultline.llm.line_dedup import Boilerplate, drop_boilerplate, host_of
from pyspark.sql import functions as F


def brute(rows, how):
    pages, counts = Counter(), Counter()
    for _, text, host in rows:
        if text is not None:
            pages[host] += 1
            counts.update({(host, line) for line in text.split("\n") if line.strip(" ")})
    gone = {k for k, n in counts.items() if n >= how.min_pages and n > how.ratio * pages[k[0]]}
    out = []
    for doc_id, text, host in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if (host, x) not in gone]
        out.append((doc_id, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)


def test_lines_go_by_their_share_of_the_host(spark):
    rows = [(i, f"menu\nown {i}\n\nmenu" + ("\nrare" if i < 2 else ""), "a.com") for i in range(10)]
    rows += [(100 + i, f"menu\npage {i}" if i < 2 else f"page {i}", "b.com") for i in range(10)]
    rows += [(200 + i, "footer\n", None) for i in range(4)]
    rows += [(i, t, "odd") for i, t in odd_texts()]
    how = Boilerplate(ratio=0.3, min_pages=3)
    for lines in (0, 100):  # joined, or broadcast
        own = Boilerplate(ratio=0.3, min_pages=3, broadcast_lines=lines)
        df = table(spark, [(i, t, None, h) for i, t, h in rows])
        out = drop_boilerplate(df, own)
        assert got(out) == brute(rows, how)
        assert [c for c in out.columns if c not in ("n_lines", "n_dropped")] == df.columns
    by = {r[0]: r for r in brute(rows, how)}
    assert by[0][1] == "own 0\n\nrare" and by[100][1] == "menu\npage 0"


def test_few_pages_drop_nothing(spark):
    rows = [(i, "only line", "tiny") for i in range(3)]
    out = drop_boilerplate(table(spark, [(i, t, None, h) for i, t, h in rows]), Boilerplate(0.1, 4))
    assert got(out) == brute(rows, Boilerplate(0.1, 4)) and {r[3] for r in got(out)} == {0}


def test_empty_table(spark):
    assert drop_boilerplate(table(spark, odd_texts()).limit(0)).collect() == []


def test_host_of(spark):
    urls = spark.createDataFrame([("https://User@WWW.Site.org:80/a?b",), ("no url",), (None,)], "u string")
    assert [r[0] for r in urls.select(host_of(F.col("u"))).collect()] == ["www.site.org", None, None]


def test_spare_counts_equal_texts_once(spark):
    rows = [(i, "menu\ncopied", "a.com") for i in range(10)] + [(10 + i, f"menu\nown {i}", "a.com") for i in range(10)]
    rows += [(20, None, "a.com"), (21, "", "a.com"), (22, "copied\nmore", None), (23, "menu", "a.com")]
    for lines in (0, 100):
        how = Boilerplate(ratio=0.3, min_pages=3, broadcast_lines=lines, spare=True)
        by = {r[0]: r[1:] for r in got(drop_boilerplate(table(spark, [(i, t, None, h) for i, t, h in rows]), how))}
        # ten rows of one text are one page: "copied" is no boilerplate, "menu" is, and stays on one page
        assert all("copied" in by[i][0] for i in range(10)) and by[22][0] == "copied\nmore"
        assert sorted(by[i][0].removeprefix("menu\n") for i in range(10, 20)) == [f"own {i}" for i in range(10)]
        assert len({t for t, *_ in by.values() if t and t.startswith("menu\n")}) <= 1
        assert by[20][0] is None and by[21][0] == "" and by[23] == ("menu", 1, 0)
