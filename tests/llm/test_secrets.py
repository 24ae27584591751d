import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from granary.llm import secrets
from granary.llm.queries import QUERIES

KINDS = {
    "assign": (re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""".replace("(?i:password|passwd|secret|token|api_?key)", "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api")) + r"_?[Kk][Ee][Yy]")), lambda m: len(m[2]) >= 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def plain(text):
    spans = sorted((m.start(), i, m.end()) for i, (pattern, ok) in enumerate(KINDS.values()) for m in pattern.finditer(text or "") if ok(m))
    base = ",".join(f"{list(KINDS)[k]}:{s}:{e}" for s, k, e in spans)
    return [sum(k == i for _, k, _ in spans) for i in range(3)] + [hashlib.sha256(base.encode()).hexdigest(), base]


def without_random(spans):
    return ",".join(x for x in spans.split(",") if not x.startswith("random"))


ODD = ["token=token=abcdefgh", "secret=token: abcdefgh", "PassWD : 'abc' api_key=\"abcdef\"", "apikey=12345 apikey=123456", "é token = abcdef.é AKIA" + "B" * 16, "AKIAAKIA12 AKIA" + "9" * 40, "𝔘𝔫 0123456789abcdef01234567", "f" * 24 + "F" + "e" * 23, "tokſn=abcdefg TOKEN=abcdefg", "secret=\"\"abcdefg", "a" * 50_000, "token=" * 9, "token\n=\nabcdefgh token=\tabcdefgh"]


@pytest.mark.parametrize("which", ["documents", "odd", "clashing", "secrets"])
def test_base_spans(spark, sf_dir, odd, which, request):
    if which == "secrets":
        docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(ODD + ODD)], odd.schema)
    else:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet") if which == "documents" else request.getfixturevalue(which)
    got = (QUERIES["op4_secret_battery"](spark, sf_dir) if which == "documents" else secrets.digest(secrets.scan(docs))).collect()
    assert sorted((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256, without_random(r.spans)) for r in got) == sorted((r.doc_id, *plain(r.text)) for r in docs.collect())


def test_no_documents(nothing):
    assert secrets.digest(secrets.scan(nothing)).collect() == []


def normal(z):
    return math.erfc(abs(z) / math.sqrt(2))


def plain_battery(word, excess):
    name = "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", word) else "base32" if re.fullmatch("[A-Z2-7]+", word) else "base64"
    alphabet = secrets.ALPHABETS[name]
    v = [alphabet.index(c) for c in (word.lower() if name == "hex" else word.replace("-", "+").replace("_", "/"))]
    n, k = len(v), len(alphabet)
    chi2 = sum((v.count(x) - n / k) ** 2 * k / n for x in range(k))
    up = [2 * x >= k for x in v]
    n1 = sum(up)
    n2 = n - n1
    mean = 2 * n1 * n2 / n + 1
    runs = 1 + sum(a != b for a, b in zip(up, up[1:], strict=False))
    p_runs = normal((runs - mean) / math.sqrt((mean - 1) * (mean - 2) / (n - 1))) if n1 and n2 else 0
    m = sum(v) / n
    square = sum((x - m) ** 2 for x in v)
    p_serial = normal((sum((a - m) * (b - m) for a, b in zip(v, v[1:], strict=False)) / square + 1 / n) * math.sqrt(n)) if square else 0
    return name, chi2, p_runs, p_serial


def test_battery_against_plain_figures(spark):
    g = random.Random(5)
    words = ["".join(g.choices(secrets.ALPHABETS[a], k=g.randint(20, 90))) for a in secrets.ALPHABETS for _ in range(15)] + ["a" * 30, "ab" * 20, "0" * 15 + "f" * 15, "aZ_-" * 9, "thequickbrownfoxjumpsoverthelazydog"]
    spans = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i long, word string")
    near = secrets.background(spans)
    assert {r.encoding for r in near.collect()} == set(secrets.ALPHABETS)
    got = {r.i: r for r in secrets.battery(secrets.symbols(spans), near).collect()}
    assert len(got) == len(words)
    for i, w in enumerate(words):
        name, chi2, p_runs, p_serial = plain_battery(w, 0)
        assert got[i].encoding == name and got[i].chi2 == pytest.approx(chi2, abs=1e-6)
        assert got[i].p_runs == pytest.approx(p_runs, abs=1e-6) and got[i].p_serial == pytest.approx(p_serial, abs=1e-6)
        assert got[i].p == 1 if min(p_runs, p_serial) < secrets.AGAINST else 0 < got[i].p <= 1


def test_step_up_against_plain_procedure(spark):
    g = random.Random(6)
    p = [10 ** -g.uniform(0, 8) if g.random() < 0.1 else g.random() for _ in range(3000)]
    level = 0.05
    rounded = sorted(10 ** (-math.floor(-math.log10(x) * 100) / 100) for x in p)
    most = max((x for i, x in enumerate(rounded, 1) if x <= i * level / len(p)), default=0)
    got = secrets.discoveries(spark.createDataFrame([(x,) for x in p], "p double"), level).count()
    assert got == sum(x <= most for x in rounded) > 50


def test_random_stretches_are_added_and_words_are_not(spark, odd):
    g = random.Random(7)
    text = lambda: " ".join("".join(g.choices("etaoinshrdlu", weights=range(12, 0, -1), k=g.choice([3, 5, 8, 24, 30]))) for _ in range(60))
    keys = ["".join(g.choices(secrets.ALPHABETS["base64"][:62], k=40)) for _ in range(40)]
    docs = spark.createDataFrame([(i, f"{text()} {keys[i] if i < 40 else ''} {text()}", None, None, None) for i in range(400)], odd.schema)
    rows = secrets.scan(docs).collect()
    found = {x.word for r in rows for x in r.random}
    assert len(found & set(keys)) >= 36
    assert len(found - set(keys)) <= 3
    assert all(r.random == sorted(r.random) for r in rows)


@pytest.mark.parametrize("n_keys, length, words", [(40, 40, True), (2000, 24, True), (2000, 88, True), (600, 40, False)])
def test_frequent_secrets_are_found(spark, odd, n_keys, length, words):
    """A source of bare keys doesn't hide itself or a key elsewhere."""
    g = random.Random(8)
    text = lambda n: " ".join("".join(g.choices("etaoinshrdlcumwfgypbvk", weights=[127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20, 19, 15, 10, 8], k=g.choice([3, 5, 8]))) for _ in range(n))
    keys = ["".join(g.choices(secrets.ALPHABETS["base64"][:62], k=length)) for _ in range(n_keys)]
    plain_stretches = ["-" * 30, "the-long-and-winding-road-that-leads", "internationalisation/localisation/settings", "averyveryverylongcompoundword"] * 9
    rows = keys + [f"{text(60)} {s} {text(60)}" for s in plain_stretches] * words
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(rows)], odd.schema)
    found = {x.word for r in secrets.scan(docs).collect() for x in r.random}
    assert len(found & set(keys)) >= 0.95 * n_keys
    assert len(found - set(keys)) <= 0.02 * n_keys, found - set(keys)


def plain_masked(text, spans):
    out, end = [], 0
    for s, e in sorted(spans):
        if s >= end or not out:
            out.append(text[end:s] + "[SECRET]")
        end = max(end, e)
    return "".join(out) + text[end:]


def test_very_many_matches_in_one_text(spark, odd):
    """More matches than are folded at a time, of all kinds, some within others: as in the plain version, and not in quadratic time."""
    rng = random.Random(3)
    parts = ["token=abcdefgh", "é secret: 'xyzxyzxyz'", "AKIA" + "Q7" * 9, "0123456789abcdef" * 2, "token=" + "ab12" * 8, "plain words", "𝔘"]
    texts = [" ".join(rng.choice(parts) for _ in range(n)) for n in (1, 255, 256, 257, 513, 3000)] + ["token=abcdefgh " * 40_000]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], odd.schema)
    got = secrets.digest(secrets.scan(docs)).collect()
    for r in got:
        assert (r.n_assign, r.n_access, r.n_hex, r.base_sha256) == tuple(plain(texts[r.doc_id])[:4])
    spans = {r.doc_id: [tuple(map(int, x.split(":")[1:])) for x in r.spans.split(",")] for r in got if r.spans}
    for r in secrets.masked(docs).collect():
        assert r.text == plain_masked(texts[r.doc_id], spans.get(r.doc_id, []))


def test_running(spark):
    for n in (0, 1, 2, 255, 256, 257, 1000):
        xs = [(i * 7919) % 101 for i in range(n)]
        sums, most = spark.createDataFrame([(xs,)], "v array<int>").select(secrets.running(F.col("v"), lambda a, b: a + b), secrets.running(F.col("v"), lambda a, b: F.greatest(a, b))).first()
        assert sums == [sum(xs[: i + 1]) for i in range(n)] and most == [max(xs[: i + 1]) for i in range(n)]
