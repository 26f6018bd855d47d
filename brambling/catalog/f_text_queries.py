"""Text, search, recommendation and graph queries."""

from pyspark.sql import functions as F

from brambling.catalog.inputs import TRANSACTIONS, is_test, is_test_sql, transactions
from brambling.catalog.registry import query
from brambling.functions import text as T
from brambling.operators import corpus, graph, recommend, search, similar, vector_index
from brambling.operators.ordering import top_k
from brambling.plans import hotel, topics
from brambling.session import settle
from brambling.sources.tables import spread

STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS)
LETTERS = r"regexp_replace(lower(trim({c})), '[^a-zA-Z\s\p{{Z}}]', '', 'g')"


def words_sql(c):
    return rf"list_filter(string_split_regex({LETTERS.format(c=c)}, '[\s\p{{Z}}]+'), lambda x: x <> '')"


SENT = r"""sl as (select source as listing, doc_id, lang, list_filter(list_transform(string_split_regex(text, '[.!?]+\s+|\n+'), lambda x: trim(x)), lambda x: x <> '') as l from documents),
  sent as (select listing, doc_id, lang, unnest(range(len(l))) as sentence_no, unnest(l) as sentence from sl)"""
CONJ = "|".join(T.CONJUNCTIONS)
CLAUSES = SENT + rf""", cl as (select listing, doc_id, lang, sentence_no, list_filter(list_transform(string_split_regex(lower(sentence), '[,;]\s*| (?:{CONJ}) '), lambda x: trim(x)), lambda x: x <> '') as l from sent),
  c0 as (select listing, doc_id, lang, sentence_no, unnest(range(len(l))) as clause_no, unnest(l) as clause from cl),
  clauses as (select *, len(list_filter(string_split_regex(clause, '\s+'), lambda x: x <> '')) as word_count from c0 where len(list_filter(string_split_regex(clause, '\s+'), lambda x: x <> '')) > 7)"""
WORDS = f"""tok as (select doc_id, unnest({words_sql('text')}) as word from documents), voc as (select word, count(*) as n from tok group by word),
  vec as (select word, embedding as vector from (select word, row_number() over (order by n desc, word) as r from voc) join embeddings on vec_id + 1 = r)"""


def texts(t):
    return spread(t.documents)


def docs(t):
    return texts(t).withColumnRenamed("source", "listing")


def clauses(t):
    return corpus.split_clauses(corpus.split_sentences(docs(t), ["listing", "doc_id"], "text"), ["listing", "doc_id"])


@query("tx1_normalize", f"select doc_id, array_to_string(list_filter({words_sql('text')}, lambda x: x not in ({STOP})), ' ') as text from documents")
def _(t):
    return texts(t).select("doc_id", T.normalize(F.col("text")).alias("text"))


@query("tx2_remove_stopwords", f"select conv_id, turn, array_to_string(list_filter(string_split(lower(text), ' '), lambda x: x not in ({STOP})), ' ') as text from conversations")
def _(t):
    kept = T.remove_stop_words(F.split(F.lower("text"), " "))
    return t.conversations.select("conv_id", "turn", F.array_join(kept, " ").alias("text"))


@query("tx3_stem")
def _(t):
    out = corpus.stem(texts(t).select("doc_id", T.words(F.col("text")).alias("tokens")), "doc_id", "tokens")
    return out.select("doc_id", F.array_join("tokens", " ").alias("stems"))


LEMMA = """lem as (select word, left(word, length(word) - 1) as lemma from voc where length(word) > 3 and right(word, 1) = 's')"""


def vocabulary(t):
    return settle(corpus.vocabulary(texts(t), "text"))


def lemmas(words):
    return words.filter((F.length("word") > 3) & F.col("word").endswith("s")).select("word", F.expr("left(word, length(word) - 1)").alias("lemma"))


@query("tx4_lemmatize", f"""with {WORDS}, {LEMMA}, w as (select doc_id, {words_sql('text')} as l from documents),
  p as (select doc_id, unnest(range(len(l))) as i, unnest(l) as word from w), g as (select doc_id, string_agg(coalesce(lemma, word), ' ' order by i) as text from p left join lem using (word) group by doc_id)
  select doc_id, coalesce(g.text, '') as text from documents left join g using (doc_id)""")
def _(t):
    tokens = texts(t).select("doc_id", T.words(F.col("text")).alias("tokens"))
    return corpus.lemmatize(tokens, "doc_id", "tokens", lemmas(vocabulary(t))).select("doc_id", F.array_join("tokens", " ").alias("text"))


LANGS = ["de", "en", "es", "fr"]


LANGUAGE = rf"""w as (select doc_id, lang, unnest(string_split_regex(lower(text), '[^\p{{L}}]+')) as word from documents), wc as (select doc_id, lang, word, count(*) as n from w where word <> '' group by all),
  v as (select distinct word, ' ' || word || ' ' as p from wc), g0 as (select word, p, unnest(range(1, length(word) + 1)) as i from v), g as (select word, substr(p, i::bigint, 3) as gram, count(*) as k from g0 group by all),
  bl as (select lang, word, sum(n) as n from wc where not {is_test_sql('doc_id')} group by all), c as (select lang, gram, sum(n * k) as c from bl join g using (word) group by all),
  tot as (select lang, sum(c) as t from c group by lang), vs as (select count(distinct gram) as v from c),
  m as (select l.lang, g.gram, ln((coalesce(c.c, 0) + 1) / (t + v + 1)) as p from tot l, vs, (select distinct gram from c) g left join c on c.gram = g.gram and c.lang = l.lang),
  ws as (select word, l.lang, sum(k * coalesce(p, ln(1 / (t + v + 1)))) as s from g cross join tot l cross join vs left join m on m.gram = g.gram and m.lang = l.lang group by all),
  ds as (select wc.doc_id, ws.lang, round(sum(n * s), 6) as s from wc join ws using (word) group by all),
  det as (select doc_id, documents.lang, arg_max(ds.lang, (s, ds.lang)) as detected from documents join ds using (doc_id) group by doc_id, documents.lang)"""


@query("tx5_keep_language", f"with {LANGUAGE} select doc_id, lang, detected from det where detected = 'en'")
def _(t):
    d = texts(t).select("doc_id", "text", "lang")
    model = corpus.fit_language(d.filter(~is_test("doc_id")), "doc_id", "text", "lang", LANGS)
    return corpus.detect_language(d, "doc_id", "text", model, LANGS).filter("detected = 'en'").select("doc_id", "lang", "detected")


def word_vectors(t):
    return corpus.ranked_vectors(corpus.vocabulary(texts(t), "text"), t.embeddings)


@query("tx6_doc_embedding", f"""with {WORDS}, k as (select doc_id, generate_subscripts(vector, 1) as d, unnest(vector)::double as x from tok join vec using (word)),
  m as (select doc_id, d, avg(x) as x from k group by all), e as (select doc_id, round(sum(x), 5) + 0.0::double as total, round(max(x) filter (d = 1), 6) + 0.0::double as head, count(*) as dims from m group by doc_id)
  select documents.doc_id, total, head, dims from documents left join e using (doc_id)""")
def _(t):
    e = corpus.doc_embedding(texts(t), "doc_id", "text", word_vectors(t))
    return e.select("doc_id", (F.round(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x), 5) + 0.0).alias("total"),
                    (F.round(F.col("embedding")[0], 6) + 0.0).alias("head"),
                    F.when(F.col("embedding").isNotNull(), F.size("embedding").cast("bigint")).alias("dims"))


@query("tx7_train_word_vectors")
def _(t):
    return corpus.train_word_vectors(texts(t), "text")


@query("tx8_split_sentences", f"with {SENT} select listing, doc_id, sentence_no, sentence from sent")
def _(t):
    return corpus.split_sentences(docs(t), ["listing", "doc_id"], "text")


@query("tx9_split_clauses", f"with {CLAUSES} select listing, doc_id, sentence_no, clause_no, clause, word_count from clauses")
def _(t):
    return clauses(t)


@query("tx10_corpus_build", f"""with {LANGUAGE}, {CLAUSES} select listing, doc_id, sentence_no, clause_no, clause, word_count,
  array_to_string(list_filter({words_sql('clause')}, lambda x: x not in ({STOP})), ' ') as text_clean from clauses where doc_id in (select doc_id from det where detected = 'en')""")
def _(t):
    d = docs(t)
    model = corpus.fit_language(d.filter(~is_test("doc_id")), "doc_id", "text", "lang", LANGS)
    _, out = hotel.build_corpus(d, "doc_id", "listing", "text", model, LANGS)
    return out.select("listing", "doc_id", "sentence_no", "clause_no", "clause", "text_clean", "word_count")


QUERIES = ["the other hand", "with reason", "entin this", "thatre anding", "is and the others"]
WEIGHTS = [1.0, 0.8, 0.6, 0.5, 0.3]


def tokens_sql(q):
    return "[" + ", ".join(f"'{w}'" for w in search.query_tokens(q)) + "]"


@query("tx11_candidate_search", f"""select doc_id, len(list_filter({tokens_sql(QUERIES[0])}, lambda w: contains(lower(text), w))) as matched from documents
  where len(list_filter({tokens_sql(QUERIES[0])}, lambda w: contains(lower(text), w))) > 0""")
def _(t):
    return search.candidate_search(texts(t), QUERIES[0], F.col("text"), ["doc_id"]).select("doc_id", "matched")


@query("j5_token_membership", f"""select item_id, text, len(list_filter({tokens_sql(QUERIES[4])}, lambda w: contains(lower(text), w))) as matched from benchmark
  where len(list_filter({tokens_sql(QUERIES[4])}, lambda w: contains(lower(text), w))) > 0""")
def _(t):
    return search.candidate_search(t.benchmark, QUERIES[4], F.col("text"), ["item_id"])


CAND = "with " + CLAUSES + r""",
  stored as materialized (select listing, doc_id, sentence_no, clause_no, clause, lower(clause) as low, list_distinct(regexp_extract_all(lower(clause), '([\p{L}\p{N}_]{2,})', 1)) as terms from clauses),
  cand as materialized (""" + " union all ".join(f"select listing, doc_id, sentence_no, clause_no, clause, {i} as criterion, {tokens_sql(q)} as wanted, terms from stored where " + " or ".join(f"contains(low, '{w}')" for w in search.query_tokens(q)) for i, q in enumerate(QUERIES)) + """),
  size as (select criterion, count(distinct term) as v from (select criterion, unnest(terms) as term from cand) group by 1),
  score as (select listing, doc_id, sentence_no, clause_no, clause, criterion, len(list_intersect(wanted, terms))::double / v as score from cand join size using (criterion))"""


def keyed_clauses(t):
    """The stored clause corpus that searches read."""
    return settle(clauses(t).withColumn("id", F.struct("doc_id", "sentence_no", "clause_no")))


@query("tx12_hamming_score", f"{CAND} select listing, doc_id, sentence_no, clause_no, criterion, round(score, 9) as score from score")
def _(t):
    hits = search.criteria_candidates(keyed_clauses(t).select("listing", "id", "clause"), QUERIES, F.col("clause"))
    return search.hamming_score(hits, "clause").select("listing", "id.*", "criterion", F.round("score", 9).alias("score"))


@query("tx13_multi_criteria_rank", f"""{CAND}, b as (select listing, {', '.join(f'max(score) filter (criterion = {i}) as s{i}' for i in range(5))} from score group by listing)
  select listing, {', '.join(f'round(coalesce(s{i}, 0), 9) as score{i + 1}' for i in range(5))}, round(({' + '.join(f'coalesce(s{i}, 0) * {w}::double' for i, w in enumerate(WEIGHTS))}) / 5, 9) as total
  from (select distinct listing from clauses) left join b using (listing)""")
def _(t):
    ranked, _ = hotel.rank_listings(keyed_clauses(t), "listing", "id", "clause", QUERIES, WEIGHTS)
    return ranked.withColumns({c: F.round(c, 9) for c in ("score1", "score2", "score3", "score4", "score5", "total")})


@query("tx14_best_evidence", f"{CAND} select listing, criterion, arg_min(clause, (-score, doc_id, sentence_no, clause_no)) as evidence, round(max(score), 9) as score from score group by listing, criterion")
def _(t):
    _, evidence = hotel.rank_listings(keyed_clauses(t), "listing", "id", "clause", QUERIES, WEIGHTS)
    return evidence.withColumn("score", F.round("score", 9))


@query("tx15_cosine_search", """with q as (select embedding::double[] as w from embeddings where vec_id = 0)
  select vec_id, label, round(list_dot_product(embedding::double[], w) / sqrt(list_dot_product(embedding::double[], embedding::double[]) * list_dot_product(w, w)), 6) + 0.0::double as similarity from embeddings, q""")
def _(t):
    wanted = t.embeddings.filter("vec_id = 0").select("embedding").first()[0]
    out = search.cosine_search(t.embeddings, "embedding", wanted)
    return out.select("vec_id", "label", (F.round("similarity", 6) + 0.0).alias("similarity"))


@query("tx15_indexed_search")
def _(t):
    """The ten nearest rows of every row whose id is divisible by 20, from an inverted-file index of all rows."""
    index = vector_index.build(t.embeddings, "vec_id", "embedding")
    return vector_index.search(index, t.embeddings.filter(F.col("vec_id") % 20 == 0), "vec_id", "embedding")


@query("tx16_word_similarity", f"""with {WORDS}, a as (select vector::double[] as x from vec where word = 'the'), b as (select vector::double[] as y from vec where word = 'and')
  select 'the' as a, 'and' as b, round(list_dot_product(x, y) / sqrt(list_dot_product(x, x) * list_dot_product(y, y)), 6) as similarity from a, b""")
def _(t):
    return corpus.word_similarity(word_vectors(t), "the", "and").withColumn("similarity", F.round("similarity", 6))


@query("tx17_count_vectorize", f"""with {WORDS} select distinct doc_id, word from tok""")
def _(t):
    return corpus.count_vectorize(texts(t), "doc_id", "text")[1].select("doc_id", "word")


@query("tx18_word_count", r"select doc_id, len(list_filter(string_split_regex(text, '\s+'), lambda x: x <> '')) as words from documents")
def _(t):
    return texts(t).select("doc_id", T.word_count(F.col("text")).alias("words"))


@query("ml24_topic_clusters")
def _(t):
    return topics.topic_clusters(texts(t), "doc_id", "lang", "text", word_vectors(t), k=8, dims=15)


# --- recommendation ----------------------------------------------------------------------------

M = f'{TRANSACTIONS}, m as (select "user", item, avg(quantity) as q from transactions group by 1, 2), norm as (select item, sqrt(sum(q * q)) as norm from m group by 1)'


@query("rc1_item_similarity", f"""with {M}, d as (select b.item, count(*) as users, sum(a.q * b.q) as dot from m a join m b using ("user") where a.item = 7 group by 1)
  select 7::bigint as seed, item, users, round(dot / (n.norm * (select norm from norm where item = 7)), 6) as similarity, p_name, p_brand from d join norm n using (item) left join part on p_partkey = item
  order by round(dot / (n.norm * (select norm from norm where item = 7)), 9) desc, item limit 5""")
def _(t):
    items = t.part.select(F.col("p_partkey").alias("item"), "p_name", "p_brand")
    return recommend.item_similarity(transactions(t), 7, items).withColumn("similarity", F.round("similarity", 6))


@query("rc2_similar_to_owned", f"""with {M}, own as (select distinct item from transactions where "user" = 10), d as (select a.item as seed, b.item, count(*) as users, sum(a.q * b.q) as dot from m a join own using (item) join m b using ("user") group by 1, 2)
  select seed, d.item, users, round(dot / (n.norm * n0.norm), 6) as similarity from d join norm n on n.item = d.item join norm n0 on n0.item = d.seed""")
def _(t):
    tr = transactions(t)
    owned = tr.filter("user = 10").select(F.col("item").alias("seed")).distinct()
    return recommend.similar_to(tr, owned).withColumn("similarity", F.round("similarity", 6))


@query("rc2_similar_items", f"""with {M}, d as (select a.item as seed, b.item, count(*) as users, sum(a.q * b.q) as dot from m a join m b on a."user" = b."user" and a.item <> b.item group by 1, 2),
  s as (select seed, d.item, users, dot / (n.norm * n0.norm) as s from d join norm n on n.item = d.item join norm n0 on n0.item = d.seed),
  r as (select *, row_number() over (partition by seed order by round(s, 9) desc, item) as rank from s) select seed, item, rank, users, round(s, 6) as similarity from r where rank <= 5""")
def _(t):
    """The five items most like every item."""
    return similar.similar_items(transactions(t)).withColumn("similarity", F.round("similarity", 6))


@query("rc3_recommend", f"""with {M}, own as (select distinct item from transactions where "user" = 10), d as (select a.item as seed, b.item, sum(a.q * b.q) as dot from m a join own using (item) join m b using ("user") group by 1, 2),
  s as (select d.item, sum(dot / (n.norm * n0.norm)) as score from d join norm n on n.item = d.item join norm n0 on n0.item = d.seed where d.item not in (select item from own) group by 1)
  select item, round(score, 6) as score from s order by round(score, 9) desc, item limit 10""")
def _(t):
    return recommend.recommend(transactions(t), 10).withColumn("score", F.round("score", 6))


@query("rc4_jaccard", f"""with {TRANSACTIONS}, p as (select distinct item, "user" from transactions), own as (select distinct item from transactions where "user" = 10), sz as (select item, count(*) as n from p group by 1),
  c as (select a.item as seed, b.item, count(*) as common from p a join own using (item) join p b using ("user") group by 1, 2)
  select seed, c.item, common, round(common / (s.n + s0.n - common), 6) as jaccard from c join sz s on s.item = c.item join sz s0 on s0.item = c.seed""")
def _(t):
    tr = transactions(t)
    owned = tr.filter("user = 10").select(F.col("item").alias("seed")).distinct()
    return recommend.jaccard_to(tr, owned).withColumn("jaccard", F.round("jaccard", 6))


@query("rc4_similar_by_users", f"""with {TRANSACTIONS}, p as (select distinct item, "user" from transactions), sz as (select item, count(*) as n from p group by 1),
  c as (select a.item as seed, b.item, count(*) as users from p a join p b on a."user" = b."user" and a.item <> b.item group by 1, 2),
  s as (select seed, c.item, users, users / (s.n + s0.n - users) as s from c join sz s on s.item = c.item join sz s0 on s0.item = c.seed),
  r as (select *, row_number() over (partition by seed order by round(s, 9) desc, item) as rank from s) select seed, item, rank, users, round(s, 6) as similarity from r where rank <= 5""")
def _(t):
    return similar.similar_items(transactions(t), cosine=False).withColumn("similarity", F.round("similarity", 6))


# --- term graphs -------------------------------------------------------------------------------

# the lexicon is read off the words themselves: a tag by hash, so that it covers any vocabulary
BUCKET = "('0x' || substr(md5(word || '|42'), 1, 8))::BIGINT % 10"
TAGGED = f"""{CLAUSES}, {WORDS}, {LEMMA}, lexi as (select word, case when {BUCKET} < 3 then 'noun' when {BUCKET} = 3 then 'connector' when {BUCKET} = 4 then 'compound' when {BUCKET} < 7 then 'adjective' end as tag from voc),
  ct as (select listing, doc_id, sentence_no, clause_no, {words_sql('clause')} as l from clauses), tk0 as (select listing, doc_id, sentence_no, clause_no, unnest(range(len(l))) as i, unnest(l) as word from ct),
  tk as (select tk0.*, tag from tk0 left join lexi using (word))"""
PW = "(partition by doc_id, sentence_no, clause_no order by i)"
PAIRS = f"""{TAGGED}, nb as (select *, last_value(case when tag = 'connector' then word end ignore nulls) over (partition by doc_id, sentence_no, clause_no order by i rows unbounded preceding) as link,
    {', '.join(f"lag(word, {k}) over {PW} as w{k}, lag(tag, {k}) over {PW} as t{k}, lead(word, {k}) over {PW} as v{k}, lead(tag, {k}) over {PW} as u{k}" for k in (1, 2))} from tk),
  n as (select * from nb where tag in ('noun', 'connector')),
  pairs as (select listing, doc_id, word as obj1, link as obj2 from n where link <> word union all select listing, doc_id, word, w1 from n where t1 = 'compound'
    union all select listing, doc_id, word, w1 from n where t1 = 'adjective' union all select listing, doc_id, word, w2 from n where t2 = 'adjective'
    union all select listing, doc_id, word, v1 from n where u1 = 'adjective' union all select listing, doc_id, word, v2 from n where u2 = 'adjective'),
  edges as (select listing, doc_id, coalesce(a.lemma, obj1) as obj1, coalesce(b.lemma, obj2) as obj2 from pairs left join lem a on a.word = obj1 left join lem b on b.word = obj2 where coalesce(a.lemma, obj1) <> 'na' and coalesce(b.lemma, obj2) <> 'na'),
  weights as (select obj1, obj2, count(*) as weight from edges group by all)"""
KEYS = ["listing", "doc_id", "sentence_no", "clause_no"]


def lexicon(words):
    digest = F.conv(F.substring(F.md5(F.concat("word", F.lit("|42"))), 1, 8), 16, 10).cast("bigint") % 10
    tag = F.when(digest < 3, "noun").when(digest == 3, "connector").when(digest == 4, "compound").when(digest < 7, "adjective")
    return words.select("word", tag.alias("tag"))


def tagged(t, words):
    return graph.tag_tokens(corpus.clause_words(docs(t), ["listing", "doc_id"], "text"), KEYS, None, lexicon(words))


def pairs(t, words):
    return graph.adjacent_pairs(tagged(t, words), KEYS).select("listing", "doc_id", "obj1", "obj2")


def edges(t, words=None):
    """One row per edge; equal pairs of a listing are named once."""
    words = vocabulary(t) if words is None else words
    counted = pairs(t, words).groupBy("listing", "obj1", "obj2").agg(F.count(F.lit(1)).alias("n"))
    named = graph.edge_table(counted, lemmas(words))
    blocks = named.withColumn("at", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 1000))))
    return blocks.withColumn("i", F.explode(F.sequence(F.lit(1), F.least(F.lit(1000), F.col("n") - F.col("at") * 1000))))


def weights(t, words=None):
    words = vocabulary(t) if words is None else words
    return graph.weighted_edges(pairs(t, words), lemmas(words))


@query("gr1_adjacent_pairs", f"with {PAIRS} select listing, doc_id, obj1, obj2, count(*) as n from pairs group by all")
def _(t):
    return pairs(t, vocabulary(t)).groupBy("listing", "doc_id", "obj1", "obj2").agg(F.count(F.lit(1)).alias("n"))


@query("gr2_edge_table", f"with {PAIRS} select listing, obj1, obj2 from edges")
def _(t):
    return edges(t).select("listing", "obj1", "obj2")


@query("gr3_edge_weight", f"with {PAIRS} select obj1, obj2, weight from weights")
def _(t):
    return weights(t)


@query("gr4_degree_filter", f"""with {PAIRS}, ends as (select obj1 as node, obj2 as other from weights union select obj2, obj1 from weights), deg as (select node, count(*) + count(*) filter (node = other) as d from ends group by 1)
  select obj1, obj2, weight from weights where obj1 in (select node from deg where d > 40) or obj2 in (select node from deg where d > 40)""")
def _(t):
    return graph.degree_filter(settle(weights(t)), 40)


@query("gr5_entity_counts", f"""with {PAIRS}, e as (select obj1 as word from edges union all select obj2 from edges) select word, count(*) as n from e where word in (select word from lexi where tag in ('noun', 'connector')) group by 1""")
def _(t):
    words = vocabulary(t)
    return graph.entity_counts(weights(t, words), lexicon(words).filter(F.col("tag").isin(*graph.NOUNS)).select("word"))


@query("gr6_nearest_subject", f"""with {TAGGED}, s as (select *, last_value(case when tag = 'connector' then word end ignore nulls) over (partition by doc_id, sentence_no, clause_no order by i rows between unbounded preceding and 1 preceding) as subject from tk)
  select listing, doc_id, subject, word as object, count(*) as n from s where tag in ('noun', 'adjective') and subject is not null group by all""")
def _(t):
    return graph.nearest_subject(tagged(t, vocabulary(t)), KEYS).groupBy("listing", "doc_id", "subject", "object").agg(F.count(F.lit(1)).alias("n"))


@query("gr7_entity_filter", f"with {PAIRS} select obj1, obj2, weight from weights where obj1 in ('the', 'and', 'of') or obj2 in ('the', 'and', 'of')")
def _(t):
    return graph.entity_filter(weights(t), ["the", "and", "of"])
