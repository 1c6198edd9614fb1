"""Base spans against the contract's expressions, disguises against what was hidden."""

import random
import re

import pytest
from conftest_llm import prose, sha
from pyspark.sql import types as T

from tierworks.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def expected(text):
    def only(s):
        return re.sub("[^0-9]", "", s)

    tests = {
        "email": (EMAIL, lambda s: True),
        "ip": (IP, lambda s: all(int(x) <= 255 for x in s.split("."))),
        "card": (CARD, lambda s: 16 <= len(only(s)) <= 19 and luhn(only(s))),
        "phone": (PHONE, lambda s: 8 <= len(only(s)) <= 15),
    }
    return {kind: [m.span() for m in pattern.finditer(text) if ok(m[0])] for kind, (pattern, ok) in tests.items()}


PARTS = ("a", "@", ".", "-", "+", "1", "25", "4111 1111 1111 1111", "256", " ", "  ", "é", "b.c@d.e", "1.2.3.4", "+49 30 (12) 34-56", "x" * 70, "(", ")", "_", "🙂", "\n", "0", "4111-1111-1111-1111")


@pytest.mark.parametrize("seed", range(6))
def test_base_equals_the_expressions(seed):
    rng = random.Random(seed)
    for _ in range(1500):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 14)))
        assert pii.base_spans(text) == expected(text), text


DISGUISED = (
    ("email", "john.doe [at] mail [dot] example [dot] com"),
    ("email", "john(at)example.org"),
    ("email", "john at example dot org"),
    ("email", "JOHN AT EXAMPLE DOT ORG"),
    ("email", "john@example dot com"),
    ("email", "john {dot} doe {at} example {dot} com"),
    ("email", "jоhn@еxample.com"),
    ("email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("email", "jo​hn­@exam​ple.com"),
    ("email", "ana arroba correo punto es"),
    ("ip", "192[.]168(dot)1 dot 17"),
    ("ip", "１９２.１６８.１.１"),
    ("ip", "one nine two dot one six eight dot one dot one"),
    ("card", "４１１１ 1111 1111 1111"),
    ("card", "four one one one one one one one one one one one one one one one"),
    ("card", "4111 1111 1111 1111"),
    ("card", "quatre un un un, un un un un, un un un un, un un un un"),
    ("phone", "plus one five five five one two three four five six seven"),
    ("phone", "+1 five five five 123 four five six seven"),
    ("phone", "+٤٩ ٣٠ ١٢٣٤٥٦"),
    ("phone", "+49 30 12‐34‐56"),
    ("phone", "plus FÜNF fünf sechs sieben acht neun null eins"),
)


def found_added(text):
    added = pii.added_spans(text, pii.base_spans(text))
    return [(kind, text[s:e]) for kind in pii.KINDS for s, e in added[kind]]


@pytest.mark.parametrize("kind,hidden", DISGUISED)
def test_disguises_are_seen_through(kind, hidden):
    for before, after in (("", ""), ("écrit: ", " …"), ("​ 日本 ", "\nnext")):
        text = before + hidden + after
        assert (kind, hidden) in found_added(text), text


def test_block_filter_lets_every_disguise_through(spark):
    rows = [(k, f"ça « {hidden} »") for k, (_, hidden) in enumerate(DISGUISED)]
    got = pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for r in got:
        kind, hidden = DISGUISED[r.doc_id]
        assert (kind, hidden) in [(s.kind, r.text[s.start : s.end]) for s in r.pii if s.added]


@pytest.mark.parametrize(
    "text",
    ["meet me at example.com", "first dot last", "one of the two or three at home", "look [at] this", "1 2 3 dot", "see (a.b) at 5", "point at the dot on the map"],
)
def test_prose_is_left_alone(text):
    assert found_added(text) == []


def test_base_spans_stay_and_are_not_added_twice():
    text = "аbob@example.com and j@x.org"
    base = pii.base_spans(text)
    assert [text[s:e] for s, e in base["email"]] == ["bob@example.com", "j@x.org"]
    assert found_added(text) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_back_mapping_by_marks(seed):
    """Every character of a rewritten text comes from where its mark says."""
    rng = random.Random(seed)
    for _ in range(300):
        source = "".join(rng.choices("abcdef", k=rng.randint(1, 30)))
        cuts = sorted(rng.sample(range(len(source) + 1), min(len(source) + 1, 2 * rng.randint(0, 4))))
        edits = [pii.Edit(a, b, rng.choice(["", "X"])) for a, b in zip(cuts[::2], cuts[1::2]) if a < b]
        made = pii.Rewritten(source, edits)
        origin, at = [], 0
        for e in edits:
            origin += [(k, k) for k in range(at, e.start)] + [(e.start, e.end - 1)] * len(e.out)
            at = e.end
        origin += [(k, k) for k in range(at, len(source))]
        assert len(origin) == len(made.text)
        for a in range(len(origin)):
            for b in range(a + 1, len(origin) + 1):
                assert made.origin((a, b)) == (origin[a][0], origin[b - 1][1] + 1)


def test_long_runs_take_linear_time():
    for text in ("x" * 1_000_000 + "@" + "y" * 1_000_000, "1" * 1_000_000, "1." * 500_000, "+" + " " * 1_000_000, "a@" * 300_000, "five " * 200_000, "(at)" * 200_000):
        base = pii.base_spans(text)
        pii.added_spans(text, base)


def test_odd_rows_and_columns(spark):
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("kind", "start", "text", "added", "spans")])
    texts = [None, "", "a@b.c", "a@b.c", "x" * 300_000 + " a@b.c"]
    df = spark.createDataFrame([("k", "s", t, None, "y") for t in texts], schema)
    got = pii.find_pii(df)
    assert got.columns == [*df.columns, "pii"]
    spans = sorted(((r.text and len(r.text)) or 0, [(s.kind, s.start, s.end, s.added) for s in r.pii], r.kind, r.spans) for r in got.collect())
    one = [("email", 0, 5, False)]
    assert spans == [(0, [], "k", "y")] * 2 + [(5, one, "k", "y")] * 2 + [(300_006, [("email", 300_001, 300_006, False)], "k", "y")]
    assert pii.find_pii(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pii.find_pii(df.withColumnRenamed("spans", "pii"))


def test_masked(spark):
    df = spark.createDataFrame([(1, "mail j@x.org or 1.2.3.4, j [at] x [dot] org"), (2, None)], "doc_id long, text string")
    assert [tuple(r) for r in pii.masked(df).orderBy("doc_id").collect()] == [(1, "mail <email> or <ip>, <email>"), (2, None)]


def test_query_against_expressions(spark, tmp_path):
    rng = random.Random(9)
    texts = [prose(rng, 50) + " " + "".join(rng.choices(PARTS, k=6)) for _ in range(60)] + [None, "", "a@b.c [at] d [dot] e"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op12_pii(spark, str(tmp_path)).collect():
        want = expected(texts[r.doc_id] or "")
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(len(want[k]) for k in pii.KINDS)
        assert r.base_sha256 == sha(pii.listed(want).encode())
        assert set(filter(None, pii.listed(want).split(","))) <= set(r.spans.split(","))
