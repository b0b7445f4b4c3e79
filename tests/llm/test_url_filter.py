import random
import re

from kindred.llm.queries import BLOCKED_URLS, URL_RULES
from kindred.llm.url_filter import ShiftAnd, _glob, judge_urls


def plain(url):
    found = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda m: m[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    if best:
        return host, path, best.name, best.verdict
    for glob in BLOCKED_URLS:
        h, _, p = glob.partition("/")
        if re.fullmatch(expression(h), host, re.S) and re.fullmatch(expression("/" + p), path, re.S):
            return host, path, None, "block"
    return host, path, None, "allow"


def expression(glob):
    return "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob)


def fits(glob, text):
    """Place by place, as patterns with many stars take an expression for ever."""
    reach = {0}
    for c in text:
        reach |= {i + 1 for i in reach if glob[i : i + 1] == "*"}
        while any(glob[i : i + 1] == "*" and i + 1 not in reach for i in reach):
            reach |= {i + 1 for i in reach if glob[i : i + 1] == "*"}
        reach = {i if glob[i] == "*" else i + 1 for i in reach if i < len(glob) and glob[i] in ("*", "?", c)}
    while any(glob[i : i + 1] == "*" and i + 1 not in reach for i in reach):
        reach |= {i + 1 for i in reach if glob[i : i + 1] == "*"}
    return len(glob) in reach


def test_verdicts_against_a_plain_version(spark):
    draw = random.Random(4)
    urls = [None, "", "no scheme", "http://", "a://b://com/", "HTTP://WWW.Example.COM/en/x", "http://net\0/es/", "http://É.net/es/"]
    for _ in range(3000):
        urls.append(
            draw.choice(["http://", "https://", "//", "x"]) + draw.choice(["", "www.", "ads.", "m.", "a.b."])
            + draw.choice(["example.com", "COM", "net", "xcom", "example.net", "x.org", "com:80", "u@example.com"])
            + draw.choice(["", "/", "/en/", "/es/1", "/EN/", "/wp-admin", "/a/login", "/9", "/x.xml", "/cart", "?q=/en/"])
            + draw.choice(["", "/912", "#top", "?page=2", "é"])
        )
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in judge_urls(pages, URL_RULES, BLOCKED_URLS).collect()}
    for i, url in enumerate(urls):
        assert got[i] == plain(url), url


def test_globs_over_several_machine_words():
    draw = random.Random(5)
    globs = ["".join(draw.choice("ab*?") for _ in range(draw.randint(1, 40))) for _ in range(40)]
    ready = ShiftAnd([_glob(g)[1:-1] for g in globs])  # without the dot and separator put around them
    assert ready.words > 4
    texts = ["".join(draw.choice("ab") for _ in range(draw.randint(0, 60))) for _ in range(300)]
    found = ready.matches(texts)
    for text, row in zip(texts, found, strict=True):
        assert row.tolist() == [fits(g, text) for g in globs]


def test_no_globs_and_first_of_equals(spark):
    pages = spark.createDataFrame([("http://a.b/c",)], "url string")
    row = judge_urls(pages, (), (), default="block").first()
    assert (row["rule"], row["glob"], row["verdict"]) == (None, None, "block")


def test_long_urls_take_linear_time():
    import re
    import time

    from kindred.llm.url_filter import SEPARATOR

    globs = ("*/wp-admin*", "*/*login*", "ads.*/*", "*/*.xml", "*a?b*" * 20)
    ready = ShiftAnd([_glob(g) for g in globs])
    texts = [".x" + SEPARATOR + "y" * 400_000 + t for t in ("login", ".xml", "axb" * 30, "")] + [".ads.z" + SEPARATOR]
    start = time.perf_counter()
    found = ready.matches(texts)
    assert time.perf_counter() - start < 15
    short = [t.replace("y" * 400_000, "y" * 40) for t in texts]
    many = ready.matches(short * 8)
    assert (many[: len(short)] == found).all()


def test_awkward_tables(spark):
    long = "http://WWW.example.com/en/" + "a/" * 100_000
    urls = [None, "", long, long, "http://a.net/es/1", "http://a.net/es/1", "https://ads.x.org" + "/9" * 5_000, "://", "x"]
    pages = spark.createDataFrame([(i // 2, u) for i, u in enumerate(urls)], "page_id long, url string").selectExpr(
        "*", "'x' AS Host", "'x' AS path", "1 AS rule", "'x' AS verdict", "'x' AS glob", "map('a', 1) AS `a map`"
    )
    out = judge_urls(pages, URL_RULES, BLOCKED_URLS)
    assert sorted(out.columns) == sorted(["page_id", "url", "a map", "host", "path", "rule", "glob", "verdict"])
    got = sorted(((r["url"] or "", r["page_id"]), (r["host"], r["path"], r["rule"], r["verdict"])) for r in out.collect())
    assert got == sorted(((u or "", i // 2), plain(u)) for i, u in enumerate(urls))
    assert judge_urls(pages.limit(0), URL_RULES, BLOCKED_URLS).collect() == []
