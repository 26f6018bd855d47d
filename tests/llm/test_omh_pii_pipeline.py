import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from brambling.llm import mix, omh, pack, pii, rules
from brambling.llm.common import settle
from brambling.llm.queries import QUERIES
from tests.llm.conftest import ODD, ROOT, rows
from tests.llm.test_jaccard import brute

# ---- order MinHash ----

MASK = (1 << 64) - 1


def chained(*values, seed=42):
    """Spark's xxhash64 of several values: each is the seed of the next."""
    for v in values:
        if v is None:
            continue
        data = v.encode() if isinstance(v, str) else v
        seed = xxhash.xxh64_intdigest(data, seed=seed & MASK)
    return seed


def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not w:
        return []
    grams = [chained(*w[i:i + omh.K]) for i in range(max(len(w) - omh.K + 1, 1))]
    signed = lambda h: h - (1 << 64 if h >> 63 else 0)
    seen, numbered = Counter(), []
    for g, i in sorted((signed(g), i) for i, g in enumerate(grams)):
        seen[g] += 1
        numbered.append((chained((g & MASK).to_bytes(8, "little"), seen[g].to_bytes(4, "little")), i))
    bins = defaultdict(list)
    for h, i in sorted(numbered):
        bins[h >> 59].append(i)
    out = []
    for b, places in bins.items():
        acc = 17
        for i in sorted(places[:omh.PICK]):
            acc = chained(acc.to_bytes(8, "little"), chained(*w[i:i + omh.K]).to_bytes(8, "little"))
        out.append(f"{b << 32 | acc & 0xFFFFFFFF:010x}")
    return sorted(out)


def plain_likeness(a, b):
    filled = {x[:2] for x in a} | {x[:2] for x in b}
    return len(set(a) & set(b)) / len(filled) if filled else 1.0


def check_fingerprints(got, docs):
    docs = [(d, t or "") for d, t in docs]
    for r, (d, t), (_, after) in zip(got, docs, docs[1:] + docs[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        a, b, c = plain_fingerprint(t), plain_fingerprint(edited), plain_fingerprint(after)
        assert (r["doc_id"], r["n_chars"], r["edited_sha256"]) == (d, len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r["fingerprint"] == "".join(a) and r["edited_fingerprint"] == "".join(b)
        assert abs(r["near_edited"] - plain_likeness(a, b)) < 1e-12 and abs(r["near_next"] - plain_likeness(a, c)) < 1e-12


def test_query_against_plain_fingerprints(spark, documents):
    docs = [(r.doc_id, r.text) for r in documents.orderBy("doc_id").collect()]
    got = rows(QUERIES["op6_order_minhash"](spark, ROOT))
    check_fingerprints(got, docs)
    long = [r for r in got if r["n_chars"] > 600]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.95 * len(long)


def test_fingerprints_of_odd_rows(odd, nothing):
    once = odd.filter("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text", "`a.b`", "key", "w", "p")
    docs = [(r.doc_id, r.text) for r in once.orderBy("doc_id").collect()]
    check_fingerprints(rows(omh.compare(settle(once))), docs)
    all_rows = rows(omh.compare(odd))
    assert len(all_rows) == len(ODD) and omh.compare(nothing).count() == 0
    one = rows(omh.compare(odd.filter("doc_id = 6")))
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_order_matters(spark):
    a, b = "a b c d e f g h i j k l m n o p " * 3, "p o n m l k j i h g f e d c b a " * 3
    df = spark.createDataFrame([(1, a, b)], "i int, text string, other string")
    r = omh.fingerprints(omh.fingerprints(df, "text", "f"), "other", "g").select(omh.likeness(F.col("f"), F.col("g")), omh.likeness(F.col("f"), F.col("f"))).first()
    assert r[0] < 0.2 and r[1] == 1.0


# ---- personal data ----

def plain_base(text):
    out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        if 16 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def test_patterns_against_plain_expressions(documents):
    rng = random.Random(5)
    texts = [r.text for r in documents.collect()] + ["".join(rng.choices("a1.@+- 9b_\n()", k=60)) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == plain_base(t)
    for slow in ("a." * 50_000, "1" * 100_000, "1." * 50_000, "+1(" * 30_000, "@" * 50_000):
        pii.base_spans(slow)


def test_query_keeps_all_base_spans(spark, documents):
    got = {r["doc_id"]: r for r in rows(QUERIES["op7_char_crf"](spark, ROOT))}
    found = 0
    for d in documents.collect():
        base, r = plain_base(d.text), got[d.doc_id]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(joined.split(",") if joined else []) <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pii.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
        found += len(base)
    assert found > 10


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(0)
    net = pii.Network.fresh()
    codes, tags = rng.integers(0, 128, (3, 7)), rng.integers(0, 9, (3, 7))
    _, grad = net.loss_and_gradient(codes, tags)
    for name in net.p:
        flat, g = net.p[name].reshape(-1), grad[name].reshape(-1)
        for k in rng.choice(len(flat), min(4, len(flat)), replace=False):
            if name == "embed" and not g[k]:
                continue
            before = flat[k]
            flat[k] = before + 1e-5
            up = net.loss_and_gradient(codes, tags)[0]
            flat[k] = before - 1e-5
            down = net.loss_and_gradient(codes, tags)[0]
            flat[k] = before
            assert abs((up - down) / 2e-5 - g[k]) < 1e-6


def test_decoding_finds_the_best_path():
    from itertools import product
    rng = np.random.default_rng(1)
    net = pii.Network.fresh()
    net.p["step"] = rng.normal(0, 1, net.p["step"].shape)
    codes = rng.integers(0, 128, (2, 4))
    e = net.emissions(codes)
    tags, sure = net.decode(codes)
    for row in range(2):
        score = lambda p: sum(e[row, t, p[t]] for t in range(4)) + net.p["first"][p[0]] + sum(net.p["step"][a, b] for a, b in zip(p, p[1:]))
        paths = list(product(range(9), repeat=4))
        scores = np.array([score(p) for p in paths])
        assert paths[int(scores.argmax())] == tuple(tags[row])
        share = np.exp(scores - scores.max())
        share /= share.sum()
        for t in range(4):
            assert abs(sum(s for s, p in zip(share, paths) if p[t] == tags[row, t]) - sure[row, t]) < 1e-9


def test_the_network_learns_held_out_spans(documents):
    texts = [r.text for r in documents.filter(F.col("text").rlike("[0-9@]")).orderBy("doc_id").collect()]
    rng = random.Random(3)
    made = []
    for i in range(260):
        who = "".join(rng.choices("abcdefgh", k=5))
        number = lambda n: "".join(rng.choices("0123456789", k=n))
        item = [f"{who}@{who[:3]}.org", f"10.{rng.randrange(256)}.{rng.randrange(256)}.7", f"+{number(2)} {number(3)} {number(4)}"][i % 3]
        made.append(f"the {who} wrote {item} in {rng.randrange(99)} days of {who}")
    codes, tags = pii.examples(made[:200] + texts[:20], limit=700)
    net = pii.train(codes, tags, epochs=10)
    test_codes, test_tags = pii.examples(made[200:])
    said, _ = net.decode(test_codes)
    labelled = test_tags > 0
    assert (said[labelled] == test_tags[labelled]).mean() > 0.9 and (said[~labelled] == 0).mean() > 0.95


def test_reconciling_against_all_sets():
    from itertools import combinations
    rng = random.Random(8)
    for _ in range(60):
        text = "+12 345 678 90 " * 8
        starts = [i for i in range(len(text)) if text[i] == "+"]
        base = [("email", s, s + 5) for s in rng.sample(starts, 2)]
        proposed = [("phone", s, s + 14, 0.9 + rng.random() / 10) for s in rng.sample(starts, 5)]
        got = pii.reconcile(text, base, proposed)
        assert [s for s in got if s[0] == "email"] == sorted(base)
        free = [p for p in proposed if all(p[2] <= b[1] or b[2] <= p[1] for b in base)]
        best = max(sum(p[3] for p in c) for k in range(len(free) + 1) for c in combinations(free, k) if all(a[2] <= b[1] or b[2] <= a[1] for a, b in combinations(c, 2)))
        assert abs(sum(dict(((p[1], p[2]), p[3]) for p in proposed)[a, b] for k, a, b in got if k == "phone") - best) < 1e-9


def test_personal_data_in_odd_rows(odd, nothing):
    found = rows(pii.find(odd, None).select("row.doc_id", "row.text", "base", "spans"))
    assert len(found) == len(ODD)
    for r in found:
        assert [(s["kind"], s["start"], s["end"]) for s in r["base"]] == plain_base(r["text"] or "") and r["base"] == r["spans"]
    clean = pii.redacted(odd, pii.fit(odd))
    assert clean.columns == odd.columns
    for r in rows(clean):
        assert r["n_chars"] == len(r["text"] or "") and not plain_base(r["text"] or "")
    assert pii.fit(nothing) is None and pii.redacted(nothing, None).count() == 0


def test_redaction():
    spans = [{"kind": "card", "start": 2, "end": 9}, {"kind": "phone", "start": 4, "end": 12}, {"kind": "ip", "start": 13, "end": 14}]
    assert pii.redact("ab0123456789c5d", spans) == "ab[CARD]c[IP]d"


# ---- pipeline ----

@pytest.fixture(scope="module")
def few(documents):
    return settle(documents.orderBy("doc_id").limit(48))


def staged(spark, name, docs):
    out = settle(dict(corpus_pipeline.STAGES)[name](spark, docs, ROOT))
    assert name == "packing" or out.columns == docs.columns
    return out


def test_quality_stage_keeps_what_the_rules_keep(spark, few):
    after = staged(spark, "quality rules", few)
    judged = rules.judge(few, rules.fit(few, spark.read.parquet(f"{ROOT}/labels.parquet")))
    assert sorted(r.doc_id for r in judged.filter("kept").select("row.doc_id").collect()) == sorted(r.doc_id for r in after.collect())


def test_join_stage_keeps_one_of_each_group(spark, few):
    after = [r.doc_id for r in staged(spark, "n-gram Jaccard join", few).collect()]
    assert sorted(after) == sorted({c for _, _, c in brute([(r.doc_id, r.text) for r in few.collect()])})


def test_personal_data_stage_redacts(spark, few):
    before, after = few.collect(), {r.doc_id: r.text for r in staged(spark, "PII", few).collect()}
    assert len(after) == len(before) and not any(plain_base(t) for t in after.values())
    clean = [r for r in before if not plain_base(r.text)]
    assert sum(after[r.doc_id] == r.text for r in clean) >= 0.95 * len(clean)


def test_mixing_stage_repeats_what_the_mix_repeats(spark, few):
    copies = {r["doc_id"]: r["copies"] for r in rows(mix.mix(few, F.array("source")))}
    after = staged(spark, "mixing sources to target weights", few).collect()
    assert Counter(r.doc_id for r in after) == Counter({i: c for i, c in copies.items() if c})


def test_stages_come_in_order_and_the_first_two_feed_the_rest(spark, few):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "PII", "mixing sources to target weights", "packing"]
    held = staged(spark, "n-gram Jaccard join", staged(spark, "quality rules", few))
    assert {r.doc_id for r in held.collect()} <= {r.doc_id for r in few.collect()} and held.count() > 0


def test_pipeline_of_odd_rows(spark, odd, nothing, tmp_path):
    for name, df in (("documents", odd), ("labels", spark.createDataFrame([], "doc_id long, quality int, toxic int"))):
        df.drop("a.b").write.parquet(f"{tmp_path}/{name}.parquet")
    docs = odd.drop("a.b")
    for start in (docs, docs.limit(0)):
        held = start
        for name, stage in corpus_pipeline.STAGES:
            held = settle(stage(spark, held, str(tmp_path)))
            if name != "packing":
                assert held.columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"


def test_pipeline_gives_the_ids_of_its_texts(spark, documents):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(corpus_pipeline.vocabulary())
    docs = documents.limit(40)
    packed = rows(dict(corpus_pipeline.STAGES)["packing"](spark, docs, ROOT), "doc_id", "start")
    ids = {}
    for r in packed:
        assert len(r["ids"]) == r["length"]
        ids.setdefault(r["doc_id"], []).extend(r["ids"])
    assert ids == {r.doc_id: tokenizer.encode(r.text or "", add_special_tokens=False).ids + [pack.END_ID] for r in docs.collect()}
