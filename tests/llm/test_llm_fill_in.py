import hashlib
import re

import duckdb
import pytest
import zstandard
from llm_cases import odd_texts, prose, rows_of, table

from faultline.llm import fill_in
from faultline.llm.fill_in import FillIn, Frames

COLUMNS = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows, how):
    out = []
    for doc_id, text in rows:
        text = text or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        n = len(units)
        h = hashlib.sha256(f"{how.seed}{'' if doc_id is None else doc_id}".encode()).hexdigest()
        h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
        a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        marks = (how.prefix, how.suffix, how.middle)
        if not text or any(m in text for m in marks) or h3 % 100 >= how.rate:
            form, whole, sizes = "plain", text, (None, None)
        elif h4 % 100 < how.spm:
            form, whole = "spm", how.suffix + suffix + how.prefix + prefix + how.middle + middle
            sizes = (len(prefix), len(middle))
        else:
            form, whole = "psm", how.prefix + prefix + how.suffix + suffix + how.middle + middle
            sizes = (len(prefix), len(middle))
        out.append((doc_id, n, form, *sizes, sha(whole), sha(text)))
    return sorted(out, key=repr)


def texts():
    rows = [(100 + i, "\n".join(prose(i, 1 + i % 7) for _ in range(i % 23)) + "\n" * (i % 3)) for i in range(80)]
    rows += [(300, "a<P>b\nc"), (301, "x\n<S"), (302, "<\n>\n<P\n"), (303, "\n" * 5000), (304, "ü漢😀\n" * 4000)]
    rows += [(305, "no line feed " * 9000), (306, "<M>"), (307, "\n"), (308, "<" * 3000 + "\n" + ">" * 10)]
    return rows + odd_texts()


@pytest.mark.parametrize("how", [FillIn(), FillIn(frame_bytes=64), FillIn(seed="x", rate=40, spm=90, frame_bytes=1000)])
def test_against_whole_strings(spark, how):
    rows = [r for r in texts() if how.frame_bytes > 64 or r[1] is None or len(r[1]) < 30_000]
    assert rows_of(fill_in.fill_in_digests(table(spark, rows), how), *COLUMNS) == brute(rows, how)


def test_sql_on_the_same_rows(spark):
    rows = [r for r in texts() if r[0] is not None and r[0] != 12]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({fill_in.DIGESTS_SQL})").fetchall()
    assert sorted(want, key=repr) == brute(rows, FillIn())


def test_real_outputs_and_stored_streams(spark):
    rows, how = texts(), FillIn(frame_bytes=5000)
    frames = fill_in.store_frames(table(spark, rows), how)
    for r in frames.collect():
        reader = zstandard.ZstdDecompressor().stream_reader(bytes(r["payload"]), read_across_frames=True)
        assert r["n"] == fill_in.line_count(reader.read())
    filled = fill_in.transform(frames, how)
    got = sorted(((r["doc_id"], r["form"], sha(r["output"])) for r in fill_in.texts(filled).collect()), key=repr)
    assert got == sorted(((r[0], r[2], r[5]) for r in brute(rows, how)), key=repr)


def test_only_cut_frames_are_opened(monkeypatch):
    text = "".join(f"line {i}\n" for i in range(20_000)).encode()
    frames = Frames.of(fill_in.chunks(text, 1000))
    opened = []
    read = Frames.text
    monkeypatch.setattr(Frames, "text", lambda self, k: opened.append(k) or read(self, k))
    form, a, b, out = fill_in.fill(5, 20_000, False, frames, FillIn())
    assert form != "plain" and len(frames) > 150 and len(opened) <= 6
    assert b"".join(fill_in.restore(form, out, FillIn())) == text


def test_marks_must_be_recognisable():
    for marks in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("ab", "ba", "cc"), ("aa", "b", "c"), ("abc", "b", "d")):
        with pytest.raises(ValueError):
            FillIn(prefix=marks[0], suffix=marks[1], middle=marks[2])
    FillIn(prefix="a", suffix="b", middle="c")


def test_empty_tables(spark):
    empty = table(spark, odd_texts()).limit(0)
    assert fill_in.fill_in_digests(empty).count() == 0
    assert fill_in.texts(fill_in.transform(fill_in.store_frames(empty))).count() == 0
