import random
import re

from quadrat.llm import urlfilter


def test_cascade_is_exact(spark, make, monkeypatch):
    rows = make([(k, f"key{k}") for k in range(3000)] + [(1, None), (2, "key1"), (3, "")])
    names = spark.createDataFrame([(f"key{k}",) for k in range(0, 6000, 7)] + [(None,), ("",)], "key string")
    for size in (16 << 20, 1500):
        monkeypatch.setattr(urlfilter, "FILTER_BYTES", size)
        got = urlfilter.mark_listed(rows, "text", names).collect()
        assert len(got) == 3003
        for r in got:
            listed = r.text == "" or bool(r.text) and int(r.text[3:]) % 7 == 0
            assert r.listed == listed, r
        assert rows.columns == urlfilter.mark_listed(rows, "text", names).columns[:-1]
    none = spark.createDataFrame([], "key string")
    assert urlfilter.mark_listed(rows, "text", none).where("listed").isEmpty()
    assert urlfilter.mark_listed(rows.limit(0), "text", names).count() == 0


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for kind, site, start in urlfilter.RULES:
        if (host == site or host.endswith("." + site)) and path.startswith(start):
            if best is None or len(site + start) > len(best[0]):
                best = (site + start, kind)
    return host, path, *(best or (None, None))


def test_judge(spark):
    draw = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "com", "xcom", "a.net", "net", "É.net", "b.org", "", "a.com:80"]
    paths = ["", "/", "/en/", "/en/x", "/EN/", "/fr/1", "/es/", "/fr", "/a\nb"]
    tails = ["", "?utm_source=x", "#top", "?a=://b/en/", "?p&utm_medium=1#x"]
    urls = [None, "", "no scheme", "://", "http://"] + [
        f"{draw.choice(['http', 'https', ''])}://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(tails)}"
        for _ in range(300)
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlfilter.judge(pages, urlfilter.tracked_keys(pages)).collect()
    tracked = {"".join(brute(u)[:2]) for u in urls if u and re.search("[?&]utm_[a-z]+=", u)}
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = brute(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if host + path in tracked else "allow"))
