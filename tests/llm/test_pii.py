import hashlib
import random
import re

from quadrat.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(p) <= 255 for p in hit.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def brute(text):
    spans = [
        [f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if valid(k, m[0])]
        for k, p in BASE.items()
    ]
    return [len(s) for s in spans], ",".join(x for s in spans for x in s)


def texts():
    draw = random.Random(7)
    parts = [
        "a@b.c", "x.y@mail-1.example.org", "_d@e.f", "@", "a@b", "..@..", "1.2.3.4", "300.1.1.1", "0001.02.3.255",
        ".5.6.7.8.9", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (988) 555-2485", "+12", "+1((((",
        "+1 2 3", "é", "日本", " ", "\n", "word", "-", "1", "12", "%", "😀", "+999999999999999999", "0" * 16, "id7",
    ]
    out = [None, "", " ", "a" * 20000, "1" * 20000, "a@" + "b." * 5000, "+1" + "(" * 9000, "1-" * 9000]
    out += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 25))) for _ in range(400)]
    return out


def test_base_equals_brute_force(make):
    rows = list(enumerate(texts())) + [(3, "a@b.c"), (3, "a@b.c"), (None, "1.2.3.4")]
    docs = make(rows)
    got = pii.report(docs, least_seeds=10**9).collect()
    assert len(got) == len(rows)
    want = sorted((repr(i), *brute(t)[0], brute(t)[1]) for i, t in rows)
    assert sorted((repr(r[0]), *r[1:5], r.base_spans) for r in got) == want
    assert all(r.spans == r.base_spans for r in got)
    assert pii.report(make([])).count() == 0


def test_context_finds_what_no_pattern_knows(make):
    rows = [(k, f"Please write your account number: 10.0.{k}.7 today") for k in range(30)]
    rows += [(100, "Please write your account number: 77.1234.5 today")]
    rows += [(101, "see chapter version 77.1234.5.x in the book")]
    rows += [(200 + k, f"some room {k}5 floor {k}777 is free") for k in range(30)]
    got = {r.doc_id: r for r in pii.report(make(rows)).collect()}
    assert got[5].spans == got[5].base_spans == "ip:34:42"
    # an address with a part missing has another shape, and so another pattern
    assert all(got[k].spans == "" for k in (101, *range(200, 230)))


def test_patterns_spread_over_the_graph(spark):
    rows = [("p", f"s{k}", "ip") for k in range(12)] + [("p", "new", None), ("q", "s1", "ip"), ("q", "s2", "ip")]
    rows += [("q", "s3", "ip"), ("q", "new", None), ("bad", "s1", "ip"), ("bad", "s2", "ip"), ("bad", "s3", "ip")]
    rows += [("bad", f"n{k}", None) for k in range(40)] + [(None, "s1", "ip")]
    graph = spark.createDataFrame(rows, "pattern string, instance string, seed string")
    got = {r.pattern for r in pii.sure_patterns(graph, sure=0.6).collect()}
    assert got == {"p", "q"}


def test_added_spans(make):
    rows = [(k, f"reach host at 10.0.0.{k} now") for k in range(20)]
    rows += [(50, "reach host at 10.0.0.999 now"), (51, "reach mate at 10.0.0.999 now")]
    got = {r.doc_id: r for r in pii.report(make(rows)).collect()}
    assert got[50].spans == "ip:14:24" and got[50].base_spans == "" and got[51].spans == ""


def test_digest(make):
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


def test_other_spellings_are_found_after_seeded_contexts(make):
    rows = [(k, f"you can call me at +1 (988) 555-2{k:03} any time you like") for k in range(30)]
    rows += [(100 + k, f"my mail address is: jane{k}@example.org, write soon please") for k in range(30)]
    cards = [d for d in (f"4111 1111 {a:04} {b:04}" for a in range(30) for b in range(10)) if luhn(d.replace(" ", ""))]
    rows += [(200 + k, f"please charge card {c} for the room") for k, c in enumerate(cards)]
    new = {
        500: ("phone", "you can call me at ", "(0355) 2485-119", " any time you like"),
        501: ("email", "my mail address is: ", "jane at example dot org", ", write soon please"),
        502: ("email", "my mail address is: ", "jane (at) mail.example [dot] org", ", write soon please"),
        503: ("card", "please charge card ", "4111 - 1111 - 1111 - 1111", " for the room"),
        504: ("email", "1.2.3.4 my mail address is: ", "joe @ example.org", ", write soon please"),
    }
    rows += [(k, before + hit + after) for k, (_, before, hit, after) in new.items()]
    rows += [(600, "look at this dot on the wall, 20 of 4111 - 1111 at noon"), (601, "the 0355 2485 119 of them")]
    got = {r.doc_id: r for r in pii.report(make(rows)).collect()}
    for k, (kind, before, hit, _) in new.items():
        assert f"{kind}:{len(before)}:{len(before) + len(hit)}" in got[k].spans.split(","), (k, got[k])
    assert got[600].spans == got[601].spans == ""
    assert all(got[k].spans == got[k].base_spans for k, _ in rows if k < 500)


def test_context_is_the_text_itself(make):
    text = "see 1.2.3.4 or call a@b.c, x1y2 then +1 (988) 555-2485 today é 3 " + "z" * 80 + " 7777 end"
    got = {(r.kind, r.hit): (r.left, r.right) for r in pii.find_matches(make([(1, text)])).collect()}
    assert got["ip", "1.2.3.4"] == (["see", "^"], ["or", "call"])
    assert got["candidate", "x1y2"] == (["c", "b"], ["then", "9"])
    assert got["phone", "+1 (988) 555-2485"] == (["then", "x9y9"], ["today", "é"])
    # a word that reaches over the bound is no context
    assert got["candidate", "7777"] == ([], ["end"])
