"""Personal data: base spans against a plain reading of the contract, and discovery by context."""

import hashlib
import math
import random
import re
from collections import defaultdict
from fractions import Fraction

from saasmart.llm import pii
from saasmart.llm.queries import QUERIES
from tests.conftest import SF001


def plain(text):
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        check = sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and check % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda x: (x[1], pii.KINDS.index(x[0])))


def test_base_spans_match_the_contract():
    rng = random.Random(6)
    bits = ["a", "b.", "@", "x@y.z", "@a.b", "1", "22", "255", "256", ".", "-", " ", "+", "+1 (743) 555-3824", "4785380592391139",
            "4785 3805 9239 1139", "1.2.3.4", "é", "\n", "(", ")", "٣", "00255", "%", "_", "c-d.e-f"]
    for _ in range(20000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain(text), text
    for text in ("a" * 30000 + "@", "1" * 30000, "+1" + " " * 30000, "@" * 30000, "1." * 20000, "a.b@" * 5000, "1 " * 20000,
                 "a@b.c," * 20000, "-" * 100000 + " 1 " + "x" * 100000 + " 2 3"):
        spans = pii.base_spans(text)
        for start, end in [*pii._identifiers(text, spans), *(x[1:] for x in spans)]:
            pii._patterns(text, start, end)


def test_query_over_documents(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op5_pii"](spark, SF001).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, *_ in want) for kind in pii.KINDS[:4])
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s and not s.startswith("context")] == [s for s in joined.split(",") if s]


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"Please reach me by phone: +1 (5{i}3) 555-10{i}4 today", "x") for i in range(6)]
    rows += [(10, "Please reach me by phone: 555-0142-77 today", "x"), (11, "The invoice number is 20240117 then", "x"),
             (12, None, "x"), (13, "", "x"), (14, "phone 12", "x"), (10, "Please reach me by phone: 555-0142-77 today", "x")]
    rows += [(20 + i, f"room {i}00{i}99 of house {i}", "x") for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row string").selectExpr("*", "1 as spans")
    got = pii.find(df).collect()
    assert len(got) == len(rows)
    found = {(r.id, a.kind, a.start, a.end) for r in got for a in r.added}
    start = rows[6][1].index("555")
    assert found == {(10, "context", start, start + 11)}
    assert sum(len(r.added) for r in got) == 2


def test_runs_of_groups():
    def runs(text):
        return [text[a:b] for a, b in pii._identifiers(text, pii.base_spans(text))]

    assert runs("call 030 123 4567 now") == ["030 123 4567"]
    assert runs("IBAN GB29 NWBK 6016 1331 9268 19. Next 5, 6") == ["GB29 NWBK 6016 1331 9268 19", "5", "6"]
    assert runs("id:" + "7" * 70) == ["7" * 70]
    assert runs("from 1.2.3.4 abx-k2 OK") == ["abx-k2"]
    assert runs('{"n":12,"at":12:30}') == ["12", "12:30"]
    assert runs("no digit AB") == runs("") == []


def test_words_around_are_whole_however_long():
    long = "w" * 5000
    assert pii._patterns(f"a {long} 77 {long}", 5003, 5005) == [f"a {pii._plain(long)} _", f"{pii._plain(long)} _ {pii._plain(long)}"]
    assert pii._patterns("77", 0, 2) == ["^ ^ _", "^ _ $"]


def accepted(edges):
    """Brute force of the graph: rounds over the whole graph until nothing is accepted."""
    instances_of, patterns_of = defaultdict(set), defaultdict(set)
    for p, i, _ in edges:
        instances_of[p].add(i)
        patterns_of[i].add(p)
    instances = {i: 1_000_000 for _, i, seed in edges if seed}
    patterns = {}
    while True:
        new = {}
        for p, of in instances_of.items():
            score = Fraction(sum(instances.get(i, 0) for i in of), len(of) + 1)
            if p not in patterns and sum(i in instances for i in of) >= pii.SUPPORT and score >= Fraction(str(pii.PATTERN_SCORE)) * 10**6:
                new[p] = math.floor(score)
        patterns |= new
        fresh = {}
        for i, of in patterns_of.items():
            left = sum(round(-math.log(1 - patterns[p] / 1e6) * 1e6) for p in of if p in patterns)
            if i not in instances and left >= round(-math.log(1 - pii.INSTANCE_SCORE) * 1e6):
                fresh[i] = round((1 - math.exp(-left / 1e6)) * 1e6)
        instances |= fresh
        if not new or not fresh:
            return patterns, instances


def test_graph_against_brute_force(spark):
    rng = random.Random(11)
    edges = []
    for g in range(60):
        n_patterns, n_instances = rng.randint(1, 8), rng.randint(3, 20)
        seeds = {i for i in range(n_instances) if rng.random() < 0.4}
        for p in range(n_patterns):
            edges += [(f"p{g}.{p}", f"i{g}.{i}", i in seeds) for i in rng.choices(range(n_instances), k=rng.randint(1, 9))]
    # a chain: each pattern holds the instances that the one before it brought in
    for k in range(6):
        edges += [(f"chain{k}", f"c{j}", j < 12) for j in range(12 * k, 12 * k + 14)] + [(f"chain{k}", f"c{j}", False) for j in range(12 * k + 14, 12 * k + 24 - 5 * (k > 2))]
    patterns, instances = pii.score_graph(spark.createDataFrame(edges, "pattern string, instance string, seed boolean").repartition(3))
    want_patterns, want_instances = accepted(edges)
    assert {r.pattern: r.score for r in patterns.collect()} == want_patterns
    assert {r.instance: r.score for r in instances.collect()} == want_instances
    assert len(want_instances) > len({i for _, i, seed in edges if seed})


def planted():
    """(rows, planted identifiers by id): three generations of contexts, each with known instances above ``PATTERN_SCORE``, and clean numbers."""
    rng = random.Random(5)
    forms = [lambda: f"0{rng.randint(10, 99)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}", lambda: f"abx-k{rng.randint(0, 9)}{rng.choice('pqrstuvw')}",
             lambda: "".join(rng.choice("0123456789") for _ in range(70)), lambda: f"{rng.randint(100, 999)} {rng.randint(10, 99)} {rng.randint(1000, 9999)}",
             lambda: f"DE{rng.randint(10, 99)} {rng.randint(1000, 9999)} {rng.randint(1000, 9999)} {rng.randint(10, 99)}"]
    rows, want = [], {}

    def add(before, value, after, hidden):
        text = f"{rng.choice(['so', 'then', 'well'])} {before} {value} {after} {rng.choice(['ok', 'bye'])}"
        if hidden:
            start = text.index(value)
            want[len(rows)] = (start, start + len(value))
        rows.append((len(rows), text))

    for _ in range(120):
        add("reach me by phone:", f"+1 (5{rng.randint(10, 99)}) 555-{rng.randint(1000, 9999)}", "today", False)
    shared = [f() for f in forms for _ in range(8)]
    for value in shared:
        add("reach me by phone:", value, "today", True)
    for value in shared:  # known from the first context, so the second one is learnt
        add("my badge code", value, "please", True)
    third = [f() for f in forms for _ in range(3)]
    for value in third:
        add("my badge code", value, "please", True)
        add("signed under key", value, "here", True)
    for f in forms:
        add("signed under key", f(), "here", True)
    for _ in range(60):
        add("the room holds", rng.randint(2, 900), "seats", False)
        add("sold for about", f"{rng.randint(2, 900)},50", "euros", False)
    return rows, want


def test_planted_identifiers_are_found_over_generations(spark):
    rows, want = planted()
    got = {r.id: [(a.start, a.end) for a in r.added] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    hit = sum(want[i] in got[i] for i in want)
    print(f"planted recall {hit} of {len(want)}")
    assert hit >= 0.9 * len(want)
    assert all(not got[i] for i, _ in rows if i not in want)


def test_empty_table(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
