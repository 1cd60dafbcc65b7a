import hashlib
import re

from llm_cases import odd_texts, table

from faultline.llm.secrets import find_secrets, literal_score, named_literals, secrets_in, span_digests, Names

HEX32 = "0123456789abcdef" * 2
CASES = [
    'password = "aB3dEf9hIjKl"',
    "PassWord:hunter2hunter2; pass word=x",
    "token=short; token = longenough",
    "token: secret: verylongvalue1",
    "api_key='abcdefgh' APIKEY=ABCDEFGH1 apikey:=x",
    "AKIA0123456789AB AKIA0123 AKIAAKIA0123456789",
    f"{HEX32} {HEX32}a {HEX32[:-1]} x{HEX32}y {HEX32.upper()}",
    'é😀 secret="zzzzzzzz"',
    "paſſword=abcdefgh toKen=abcdefgh",  # long s and Kelvin sign are no ASCII letters
    'password  :   "a.b-c/d+e="',
    "passwordpassword=aaaaaaaa",
]


def brute(text):
    out = []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [("assign", *m.span()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def test_base_spans_and_digests(spark):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(None if i is None else 100 + i, t) for i, t in odd_texts()]
    got = span_digests(find_secrets(table(spark, rows))).collect()
    want = {}
    for i, t in rows:
        base = brute(t or "")
        sha = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        counts = tuple(sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex"))
        want.setdefault(i, []).append((*counts, sha))
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) in want[r.doc_id]
        assert len([s for s in r.spans.split(",") if s]) == r.n_assign + r.n_access + r.n_hex + r.n_named
    assert find_secrets(table(spark, rows).limit(0)).count() == 0


def named(text):
    return [text[a:b] for kind, a, b, _ in secrets_in(text) if kind == "named"]


def test_names_decide():
    assert named('db.pwd = "qwErty12+x"') == ["qwErty12+x"]
    assert named("AuthToken => 'Zx81-Zx82-Zx83'") == ["Zx81-Zx82-Zx83"]
    assert named('"private_key": "MIIEvQ1BADAN/Bgkq"') == ["MIIEvQ1BADAN/Bgkq"]
    assert named('title = "qwErty12+x"\nkeyboard: "qwErty12+x"\npassage := "qwErty12+x"') == []
    assert named('pwd == "qwErty12+x"\npwd != "qwErty12+x"\nif pwd <= limit') == []
    assert named('pwd = "your-password-1"\npwd = "${FROM_ENV_1}"\npwd = "aaaaaaaaaaaa"\npwd = "xY1"') == []


def test_constants_are_propagated():
    text = 'k = "aB3dEf9hIjKl"\nother = k\nclient.credentials: other\n'
    assert named(text) == ["aB3dEf9hIjKl"]
    assert named('k = "aB3dEf9hIjKl"\nname = k') == []
    assert named("credential = someVariable") == []


def test_base_spans_are_not_repeated():
    assert [s[0] for s in secrets_in('my_password = "aB3dEf9hIjKl"')] == ["assign"]


def test_long_blanks_take_no_time():
    assert secrets_in("x" + " " * 200_000 + "= 1 " + "g" * 200_000 + "=" * 1000) == []
    assert len(named_literals('pwd = "aB3dEf9hIjKl"\n' * 20_000, Names(), 0.5)) == 20_000
    assert literal_score("aB3dEf9hIjKl") > 0.9 > literal_score("abcdefab")
