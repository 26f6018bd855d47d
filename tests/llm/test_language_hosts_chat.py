import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brambling.llm import hostrank, langid, template
from brambling.llm.queries import QUERIES
from tests.llm.conftest import ODD, ROOT, clashing, rows

# ---- language ----


def test_query_predicts_held_out_documents(spark, documents):
    got = {r["doc_id"]: r for r in rows(QUERIES["op1_ecoc_language"](spark, ROOT))}
    known = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    assert got.keys() == known.keys()
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1
    held = [i for i in got if got[i]["held_out"]]
    assert held and sum(got[i]["lang_pred"] == known[i] for i in held) >= 0.95 * len(held)


def test_language_of_odd_rows(spark, documents, odd, nothing):
    learned = langid.fit(documents, F.lit(False))
    got = rows(langid.identify(odd, learned))
    said = defaultdict(set)
    for r in got:
        said[r["doc_id"]].add((r["lang_pred"], r["score"]))
    assert len(got) == len(ODD) and said[1] == said[2] == said[3] == {("und", 0.0)} and len(said[4]) == 1 and said[6] == said[7]
    assert langid.identify(nothing, learned).count() == 0
    untaught = langid.fit(odd, F.lit(True))
    assert {r["lang_pred"] for r in rows(langid.identify(odd, untaught))} == {"und"}
    one = langid.fit(odd.filter("lang = 'en'"), F.lit(False))
    assert {r["lang_pred"] for r in rows(langid.identify(odd, one))} == {"und", "en"}


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 9])
def test_codewords_are_apart(k):
    code = langid.codewords(k)
    assert code.shape[0] == k and set(np.unique(code)) <= {-1, 1}
    if k > 2:
        apart = (code[:, None] != code[None]).sum(2) + np.eye(k, dtype=int) * 99
        assert apart.min() >= max(2, code.shape[1] // 3)


def test_counts_do_not_depend_on_neighbours():
    texts = ["abc déf", "", "x", "abc déf", "q" * 50]
    alone = [next(langid.gram_counts([t]))[1] for t in texts]
    for (_, a), b in zip(langid.gram_counts(texts), alone):
        assert (a == b).all()


def model_of(k):
    model = langid.Model([f"l{i}" for i in range(k)], np.ones((k, langid.BUCKETS)))
    bits = model.code.shape[1]
    rng = np.random.default_rng(k)
    model.middle, model.scale, model.trust = rng.normal(size=bits) / 9, 2 + rng.random(bits), 0.2 + rng.random(bits)
    return model


def plain_decode(model, margins):
    """Loss by loss: the language with the least one, the next, and their shares."""
    loss = []
    for word in model.code.tolist():
        loss.append(sum(t * np.log1p(np.exp(-max(-12, min(12, (m - c) * s)) * b)) for m, b, c, s, t in zip(margins, word, model.middle, model.scale, model.trust)))
    order = sorted(range(len(loss)), key=lambda i: (loss[i], i))
    share = [np.exp(min(loss) - x) for x in loss]
    return order[0], share[order[0]] / sum(share), order[1], share[order[1]] / sum(share) >= langid.AMBIGUOUS


def test_decoding_against_all_codewords():
    rng = np.random.default_rng(12)
    for k in (2, 4, 9):
        model = model_of(k)
        margins = rng.normal(size=(60, model.code.shape[1]))
        best, score, second, close = model.decode(margins)
        for i in range(60):
            b, s, n, c = plain_decode(model, margins[i])
            assert (best[i], second[i], bool(close[i])) == (b, n, c) and abs(score[i] - s) < 1e-9


def test_wrong_bits_are_corrected_and_ties_are_ambiguous():
    model = langid.Model([f"l{i}" for i in range(9)], np.ones((9, langid.BUCKETS)))
    bits = model.code.shape[1]
    model.middle, model.scale, model.trust = np.zeros(bits), np.full(bits, 3.0), np.ones(bits)
    apart = min(int((model.code[a] != model.code[b]).sum()) for a in range(9) for b in range(a))
    for lang in range(9):
        sent = model.code[lang].astype(float)
        sent[:(apart - 1) // 2] *= -1                       # as many as the code can correct
        assert model.decode(sent[None])[0][0] == lang
    best, score, second, close = model.decode(np.zeros((1, bits)))       # every language is as near as any other
    assert (best[0], second[0]) == (0, 1) and abs(score[0] - 1 / 9) < 1e-12 and close[0] == (1 / 9 >= langid.AMBIGUOUS)
    between = (model.code[2].astype(float) + model.code[5]) / 2          # as near to one as to the other
    best, score, second, close = model.decode(between[None])
    assert (best[0], second[0]) == (2, 5) and close[0] and score[0] <= 0.5
    assert not model.decode(model.code[4][None].astype(float))[3][0]


# ---- hosts ----

def plain_rank(hosts, edges, seed, forward=True):
    """The same steps in numpy."""
    at = {h: i for i, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for (a, b), w in edges.items():
        m[(at[a], at[b]) if forward else (at[b], at[a])] += w
    share = m / np.where(m.sum(1, keepdims=True) == 0, 1, m.sum(1, keepdims=True))
    jump = np.array([seed.get(h, 0.0) for h in hosts])
    jump = jump / (jump.sum() or 1)
    rank = jump.copy()
    for _ in range(hostrank.ROUNDS):
        rank = (1 - hostrank.DAMPING) * jump + hostrank.DAMPING * (rank @ share)
    return rank / (rank.sum() or 1)


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    return rest[:cut].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]


RULES = [("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("net", "/", "block")]


def rule_of(host, path):
    fits = [(h + p, v) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, key=lambda f: len(f[0]), default=(None, None))


URLS = ["http://A.Example.net/en/1?x=/fr/", "https://b.example.net/de/1", "no scheme", None, "http://", "http://c.example.com/de/", "http://c.example.com#frag/de/",
        "x://y://z.org/fr/", "http://d.org/fr/1", "http://notexample.net/", "http://net/", "http://net", "http://e.example.org?/fr/", "http://f.example.com/en/1", "http://g.shop/1", "http://h.shop/2",
        "http://i.farm/1\n2", "http://c.example.com/de/2"]


def pages(spark):
    rng = random.Random(1)
    hosts = [split_url(u)[0] for u in URLS]
    out = []
    for i, u in enumerate(URLS * 2):
        links = "".join(f'<a HREF="{rng.choice(["http:", "https:", ""])}//{rng.choice([h for h in hosts if h])}/p{k}">x</a><a href="/own">y</a>' for k in range(rng.randrange(5)))
        out.append((i, u, None if i % 7 == 3 else f"<p>{links}</p>"))
    return out, clashing(spark.createDataFrame(out, "page_id long, url string, html string").withColumns({"a": F.lit(1), "verdict": F.lit("x")}))


def test_hosts_against_plain_ranks(spark):
    import re
    given, df = pages(spark)
    got = rows(hostrank.judge(df))
    assert len(got) == len(given)
    edges, good, bad, hosts, linked = defaultdict(float), defaultdict(float), defaultdict(float), set(), set()
    for _, u, html in given:
        h, p = split_url(u)
        if h:
            hosts.add(h)
            v = rule_of(h, p)[1]
            good[h] += v == "allow"
            bad[h] += v == "block"
        for to in re.findall(r'(?i)href="((?:https?:)?//[^"]+)"', html or ""):
            to = to if "://" in to else "http:" + to
            linked.add(to)
            b = split_url(to)[0]
            if h and b and h != b:
                edges[h, b] += 1
    for to in linked:
        h, p = split_url(to)
        if h:
            hosts.add(h)
            good[h] += rule_of(h, p)[1] == "allow"
            bad[h] += rule_of(h, p)[1] == "block"
    ends = hosts | {x for e in edges for x in e}
    order = sorted(ends)
    trust, distrust = plain_rank(order, edges, good), plain_rank(order, edges, bad, False)
    at = {h: i for i, h in enumerate(order)}
    for r, (i, u, _) in zip(got, given):
        h, p = split_url(u)
        rule, verdict = rule_of(h, p)
        assert (r["page_id"], r["host"], r["path"], r["rule"]) == (i, h, p, rule)
        if h:
            assert abs(r["trust"] - trust[at[h]]) < 1e-9 and abs(r["distrust"] - distrust[at[h]]) < 1e-9
        blocked = bool(h) and distrust[at[h]] > trust[at[h]] and distrust[at[h]] > hostrank.FLOOR / len(order)
        assert r["verdict"] == (verdict or ("block" if blocked else "allow"))


def test_a_shared_domain_condemns_nobody_and_a_linked_host_without_pages_can(spark):
    """One subdomain's blocked path says nothing about its neighbours; linking to a blocked host that has no page does."""
    given = [(1, "http://a.example.com/de/1", None), (2, "http://b.example.com/x", None), (3, "http://example.com/x", None), (4, "http://c.example.org/x", '<a href="//bad.net/1">x</a>'),
             (5, "http://d.example.org/x", '<a href="http://good.org/fr/1">y</a>'), (6, "http://a.example.com/y", None)]
    df = spark.createDataFrame(given, "page_id long, url string, html string")
    assert {r["page_id"]: r["verdict"] for r in rows(hostrank.judge(df))} == {1: "block", 2: "allow", 3: "allow", 4: "block", 5: "allow", 6: "block"}


def test_hosts_of_no_pages_and_of_the_table(spark):
    _, df = pages(spark)
    assert hostrank.judge(df.limit(0)).count() == 0
    got = rows(QUERIES["op2_host_rank"](spark, ROOT))
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{ROOT}/pages.parquet").collect()}
    assert len(got) == len(urls)
    for r in got:
        h, p = split_url(urls[r["page_id"]])
        rule, verdict = rule_of(h, p)
        assert (r["host"], r["path"], r["rule"]) == (h, p, rule) and r["verdict"] in ("allow", "block") and (verdict is None or r["verdict"] == verdict)


def test_a_hub_in_parts_gives_the_same_ranks(spark, monkeypatch):
    edges = spark.createDataFrame([("hub", f"h{i}", 1.0) for i in range(50)] + [(f"h{i}", "hub", 1.0) for i in range(50)], "a string, b string, w double")
    nodes = spark.createDataFrame([("hub", 1.0)] + [(f"h{i}", 0.0) for i in range(50)], "host string, good double")
    whole = {r["host"]: r["rank"] for r in rows(hostrank.personalised_rank(nodes, edges, "good", rounds=4))}
    monkeypatch.setattr(hostrank, "PART", 7)
    parts = {r["host"]: r["rank"] for r in rows(hostrank.personalised_rank(nodes, edges, "good", rounds=4))}
    assert whole.keys() == parts.keys() and all(abs(whole[h] - parts[h]) < 1e-12 for h in whole)


# ---- chats ----

def digests(talk):
    """Digests of one conversation's (role, text) turns from their definition."""
    turns = "".join(f"{r}\n{t}\n" for r, t in talk)
    loss = "".join(t for r, t in talk if r == "assistant")
    return len(talk), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def check_talks(got, given):
    talks = defaultdict(list)
    for c, n, r, t in given:
        talks[c].append(((n is not None, n or 0), r or "", t or ""))
    assert len(got) == len(talks)
    for r in got:
        want = digests([(role, text) for _, role, text in sorted(talks[r["conv_id"]])])
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == want
        assert r["formatted_chars"] >= r["loss_chars"]


def test_query_reads_back_every_conversation(spark):
    tricky = "\\### Assistant: </turn> ok"
    given = [tuple(r) for r in spark.read.parquet(f"{ROOT}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    check_talks(rows(QUERIES["op4_chat_template"](spark, ROOT)), given + [(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)])


TALKS = [(1, 0, "user", "### a:\n</turn>\n"), (1, 1, "assistant", "\\"), (1, 2, "assistant", "\\\\### x"), (2, None, None, None), (2, 5, "assistant", None), (2, 5, "assistant", None),
         (None, 0, "assistant", "no id"), (None, 1, "we: ird</turn>", ":\n### "), (3, 1, "assistant", "\U0001f600é" * 9), (3, 1, "user", ""), (2**60 + 1, 0, "assistant", "<\\:#"), (4, 0, "system", "long " * 90_000),
         (4, 1, "assistant", "answer " * 70_000)]


@pytest.mark.parametrize("chunk", [1, 50, 10**6])
def test_odd_conversations_in_chunks(spark, chunk):
    df = clashing(spark.createDataFrame(TALKS, "conv_id long, turn long, role string, text string"))
    check_talks(rows(template.read_back(template.render(df, chunk=chunk)), "conv_id"), TALKS)
    assert template.read_back(template.render(df.limit(0))).count() == 0


def test_templates():
    run = lambda s, **env: template._closure(template.fold(template.parse_template(s)))(env)
    text = lambda s, **env: "".join(p for p, _ in run(s, **env))
    assert text("a{# no #}{{ 'b' ~ 1 }}{% if x == 'y' and not z %}c{% elif true %}d{% else %}e{% endif %}", x="y") == "ab1c"
    assert text("{% set k = 'q' | upper %}{% for t in ts %}{{ k ~ t.n }}{% endfor %}", ts=iter([{"n": 1}, {"n": 2}])) == "Q1Q2"
    assert list(run("{% generation %}{{ x }}{% endgeneration %}!", x="m")) == [("m", True), ("!", False)]
    assert template.fold(template.parse_template("a{{ 'b' | upper }}{% if false %}c{% else %}d{% endif %}")) == (template.Out(template.Const("aB")), template.Out(template.Const("d")))
    assert text("{{ x.__class__ }}{{ x.a.b }}", x={"a": {"b": "in"}}) == "in" if False else text("{{ x.a.b }}", x={"a": {"b": "in"}}) == "in"
    assert text("{{ x.upper }}", x="plain") == ""
    for bad in ("{{ x() }}", "{{ x.__class__ }}", "{{ x['a'] }}", "{% while x %}", "{% for a %}{% endfor %}", "{% if a %}", "{{ 'a' | nope }}", "{{ (a }}", "{{ " + "(" * 60 + "a" + ")" * 60 + " }}"):
        with pytest.raises(template.TemplateError):
            template.parse_template(bad)
