import random
import re

import numpy as np

from tierflow.llm import url_filter
from tierflow.llm.url_filter import ALLOW, BLOCK, Automaton, Filter, glob_rule, host_rule, judge


def as_regex(glob):
    out = ""
    for piece in re.split(r"(\*\*|\*|\?)", glob):
        out += {"**": r".*", "*": r"[^/]*", "?": r"[^/]"}.get(piece, re.escape(piece))
    return re.compile(out, re.DOTALL)


def strings(texts):
    raw = [t.encode() for t in texts]
    length = np.array([len(r) for r in raw], np.int64)
    return np.frombuffer(b"".join(raw) or b"\0", np.uint8), np.cumsum(length) - length, length


def test_automaton_equals_regular_expressions():
    rng = random.Random(3)
    for _ in range(30):
        globs = ["".join(rng.choice(["a", "b", "/", "é", "*", "**", "?", "ab"]) for _ in range(rng.randrange(1, 8))) for _ in range(25)]
        texts = ["".join(rng.choice("ab/éb") for _ in range(rng.randrange(0, 14))) for _ in range(40)] + ["a" * 70, ""]
        automaton = Automaton(globs)
        assert automaton.words > 1  # masks of several words, patterns across their edges
        found = set(zip(*[part.tolist() for part in automaton.run(*strings(texts))], strict=True))
        assert found == {(i, j) for i, t in enumerate(texts) for j, g in enumerate(globs) if as_regex(g).fullmatch(t)}


def test_rules_in_blocks_give_the_same_winner():
    rng = random.Random(4)
    rules = tuple(glob_rule(BLOCK, "".join(rng.choice(["a", "b", "*"]) for _ in range(rng.randrange(1, 6)))) for _ in range(40))
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(0, 6))) for _ in range(60)]
    whole, split = (Filter(rules, states).winners(*strings(texts), 20) for states in (1 << 14, 30))
    for which, (a, b) in enumerate(zip(whole, split, strict=True)):
        assert a.tolist() == b.tolist()
        for text, won in zip(texts, a.tolist(), strict=True):
            hits = [i for i in (range(20) if which == 0 else range(20, 40)) if as_regex(rules[i].glob).fullmatch(text)]
            assert won == (max(hits, key=lambda i: (len(rules[i].name), -i)) if hits else -1)


def test_the_longest_rule_decides(spark):
    urls = {
        "https://a.example.org/es/1": ("example.org/es/", BLOCK), "http://EXAMPLE.ORG/en/12": ("example.org/en/1", BLOCK),
        "http://example.org/en/2": ("org/", ALLOW), "http://badexample.org/es/1": ("org/", ALLOW), "http://example.org": (None, ALLOW),
        "http://example.org?x=/es/": (None, ALLOW), "http://x.com/fr/casino": ("com/fr/", ALLOW), "http://x.com/de/": ("com/de/", BLOCK),
        "http://x.com/a.org/b": (None, ALLOW), "http://casino-win.net/a": (None, BLOCK), "http://a.net/casino-x": (None, ALLOW),
        "http://x.com/DE/": (None, ALLOW), "http://Ünï.org/ß\n/": ("org/", ALLOW), "http://a#://b.org/": (None, ALLOW),
    }
    df = spark.createDataFrame([(i, u, "clash", "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    assert [(r.rule, r.verdict) for r in judge(df).sort("page_id").collect()] == list(urls.values())


def test_odd_rows(spark):
    long = "http://a.org/" + "x" * 100_000 + "?q"
    df = spark.createDataFrame([(1, None), (1, None), (None, "no url"), (2, ""), (3, long), (4, "://"), (5, "a://b://c/d")], "page_id int, url string")
    found = {r.page_id: r for r in judge(df).collect()}
    assert judge(df).count() == 7 and judge(df).schema["page_id"].dataType.typeName() == "integer"
    assert all((found[i].host, found[i].path, found[i].rule, found[i].verdict) == ("", "", None, ALLOW) for i in (1, None, 2, 4))
    assert found[3].path == long[12:-2] and found[3].rule == "org/" and (found[5].host, found[5].path) == ("b:", "//c/d")
    assert judge(df.limit(0)).count() == 0
    assert judge(df, rules=[], globs=[], otherwise=BLOCK).where("verdict = 'block'").count() == 7
    assert judge(df, rules=[host_rule(BLOCK, "org", ""), *url_filter.HOST_RULES]).where("page_id = 3").first().rule == "org/"
