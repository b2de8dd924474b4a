"""Operators 1, 3, 9 and 10: round trips, held-out accuracy and plain rules."""

import collections
import hashlib
import random

import numpy as np
import pytest

from tessera.llm import chat, langid, quality, url_templates
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType


def brute_chat(rows):
    groups = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        targets = "".join(t for _, _, role, t in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(),
                     len(targets), hashlib.sha256(targets.encode()).hexdigest())
    return out


PROBE = [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)]
CHAT = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "a<\\\\|b<|im_end|>\n", "<", "|", "\\", chat.PROBE])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)
    assert list(chat.parse(chat.render(text, text)[0] * 2)) == [(text, text)] * 2


@pytest.mark.parametrize("budget", [64, 2048])
def test_chat_windows_read_back(spark, budget):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i} <|im_end|> <\\| <\\\\|x" * (i % 7)) for i in range(700)]
    rows += [(1, 0, "system", "sys <"), (2, None, None, None), (2, 5, "a\nb\\n", "x"), (None, 1, "user", "|im_end|>")]
    rows += [(3, 7, "user", "same")] * 900 + [(4, 300, "system", "late"), (4, 2, "user", "q"), (4, 600, "assistant", "z" * 9000), (4, 601, "assistant", "")]
    table = spark.createDataFrame(rows, CHAT).withColumn("segment", F.lit("x")).withColumn("n_turns", F.lit(9))
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.format_digests(table, budget).collect()}
    assert got == brute_chat(rows + PROBE)
    windows = chat.format_conversations(table, budget).collect()
    assert all(w.n_tokens <= budget or (w.n_turns == 1 and w.context_chars == 0) for w in windows)


@pytest.mark.parametrize("budget", [80, 2048])
def test_context_reaches_over_segments(spark, budget):
    """Turns are numbered by place; every window has the system turn and the history right before it."""
    rows = [(1, 1000 * i, "system" if i == 2 else "user", f"say {i}") for i in range(600)]
    windows = sorted(chat.format_conversations(spark.createDataFrame(rows, CHAT), budget).collect(), key=lambda w: (w.segment, w.window))
    assert {w.segment for w in windows} == {0, 1, 2} and all(w.n_tokens <= budget for w in windows)
    place = 0
    for w in windows:
        context = [t for _, t in chat.parse(w.text[:w.context_chars])]
        own = [t for _, t in chat.parse(w.text[w.context_chars:])]
        assert own == [f"say {i}" for i in range(place, place + len(own))]
        if place > 2:
            assert context[0] == "say 2" and len(context) <= 1 + chat.HISTORY_TURNS
            assert context[1:] == [f"say {i}" for i in range(place - len(context) + 1, place)]
            assert len(context) > 1 or place == 3
        place += len(own)
    assert place == 600


def test_no_conversations(spark):
    got = chat.format_digests(spark.createDataFrame([], CHAT)).collect()
    assert [(r.conv_id, r.n_turns) for r in got] == [(-1, 2)]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.predict_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.97 * len(found)
    assert sum(r.rejected for r in found) <= 0.02 * len(found)
    assert all(0 <= r.score <= 1 for r in found)


def test_unknown_languages_are_rejected(spark):
    """A language that no label names goes, and so do letters without a language; learned ones stay."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rng = random.Random(4)
    noise = [" ".join("".join(rng.choices("bcdfghjklmnpqrstvwxz", k=rng.randint(2, 9))) for _ in range(60)) for _ in range(100)]
    for left_out in ("de", "fr"):
        model = langid.fit(docs.where(F.col("lang") != left_out), ~langid.held_out())
        own = docs.where(langid.held_out() & F.col("text").rlike("[A-Za-z]")).select("text", "lang")
        own = own.unionByName(spark.createDataFrame([(t, "noise") for t in noise], "text string, lang string"))
        gone = {r.kind: r.gone for r in langid.identify(own, model).groupBy(
            F.when(F.col("lang").isin(left_out, "noise"), F.col("lang")).otherwise("learned").alias("kind"))
            .agg(F.avg(F.col("language.rejected").cast("int")).alias("gone")).collect()}
        assert gone[left_out] >= 0.8 and gone["noise"] >= 0.95 and gone["learned"] <= 0.01, gone


def test_language_of_odd_documents(documents, odd_docs, no_docs):
    model = langid.fit(documents, ~langid.held_out(), sample_docs=80)
    named = langid.identify(odd_docs, model, out="language")
    assert named.columns == [*odd_docs.columns, "language"] and named.count() == odd_docs.count()
    for r in named.collect():
        letters = any(map(str.isalpha, r.text or ""))
        assert (r.language.lang == "und") == (not letters)
        assert letters or (r.language.score == 0 and r.language.rejected)
    assert langid.predict_languages(no_docs).collect() == []
    assert {r.lang_pred for r in langid.predict_languages(odd_docs).collect()} == {"und"}  # nothing to learn from


def test_quality_separates_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    few = labels.where("doc_id % 4 = 0")
    found = quality.judge_documents(docs, few).join(labels, "doc_id").where("doc_id % 4 <> 0").collect()
    good = [r for r in found if r.quality == 1 and r.toxic == 0]
    poor = [r for r in found if r.quality == 0]
    toxic = [r for r in found if r.toxic == 1]
    assert sum(r.kept for r in good) >= 0.985 * len(good)
    assert sum(r.kept for r in poor) <= 0.05 * len(poor)
    assert sum(r.kept for r in toxic) <= 0.2 * len(toxic)


def test_labels_of_other_documents_take_no_place(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").select("doc_id", "quality", "toxic")
    others = spark.range(10**9, 10**9 + 50_000).selectExpr("id doc_id", "id % 2 quality", "0 toxic")
    few, many = (quality.fit(docs, known, sample_docs=200) for known in (labels, labels.unionByName(others)))
    assert few is not None and many is not None
    assert few.lexicon == many.lexicon and (few.weights == many.weights).all()


def test_quality_of_odd_documents(spark, documents, odd_docs, no_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    judged = quality.judge(documents.unionByName(odd_docs, allowMissingColumns=True), labels, out="judged")
    assert judged.count() == documents.count() + odd_docs.count()
    assert all(0 < r.judged.score < 1 for r in judged.collect())
    assert quality.judge_documents(no_docs, labels).collect() == []
    unlabelled = quality.judge_documents(odd_docs, labels.limit(0)).collect()
    assert len(unlabelled) == odd_docs.count() and all(r.kept and r.score == 0.5 for r in unlabelled)


def test_sparse_sites_shrink_toward_the_whole(spark):
    rows = [("big", "a", 0.9)] * 500 + [("bad", "a", 0.1)] * 500 + [("small", "a", 0.1)] + [("big", "b", 0.9)] * 2 + [(None, None, 0.9)]
    found = {(r.host, r.path): r for r in quality.site_priors(spark.createDataFrame(rows, "host string, path string, p double")).collect()}
    assert abs(found["big", "a"].path_prior - 0.9) < 0.02 and abs(found["bad", "a"].path_prior - 0.1) < 0.02
    assert 0.1 < found["small", "a"].host_prior < 0.5 and (None, None) in found


def plain_url(url):
    """(host, path, rule, verdict) by the rules alone."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:cut], rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in url_templates.RULES:
        if (host == rule[0] or host.endswith("." + rule[0])) and path.startswith(rule[1]):
            best = max([best, rule], key=lambda r: len(r[0] + r[1]) if r else -1)
    return host, path, best and best[0] + best[1], best and best[2]


def test_url_rules(spark):
    urls = [None, "", "example.org/es/1", "http://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "https://example.org", "x://y?/fr/", "a://b://c/d",
            "http://badexample.org/es/", "http://com/de/", "http://x.com/de", "http://x.COM/fr/\n1", "http://É.com/de/É", "http://h#/de/"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] + [(3, urls[3])], "page_id long, url string").selectExpr("*", "'q' host", "1 n")
    pages = pages.unionByName(spark.read.parquet("/root/testdata/sf0.01/pages.parquet").selectExpr("page_id + 100 page_id", "url", "html host", "1 n"))
    found = collections.defaultdict(list)
    for r in url_templates.filter_urls(pages).collect():
        found[r.page_id].append(r)
    assert sum(map(len, found.values())) == pages.count()
    for r in pages.collect():
        host, path, rule, verdict = plain_url(r.url)
        for got in found[r.page_id]:
            assert (got.host, got.path, got.rule) == (host, path, rule)
            assert got.verdict == verdict if verdict else got.verdict in ("allow", "block")
    assert url_templates.filter_urls(pages.limit(0)).collect() == []


def test_templates_generalise_and_reject(spark):
    rules = (("site.net", "/spam/a", "block"), ("site.net", "/news/a", "allow"))
    urls = [f"http://site.net/{part}/{first}{i}/x" for part in ("spam", "news") for first in ("a", "b") for i in range(40)]
    urls += [f"http://site.net/only-{c}/x" for c in "cdefghijklmnopqrstuvw"]
    found = {r.path: r for r in url_templates.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert found["/spam/b3/x"].template == "/spam/*/x" and found["/spam/b3/x"].verdict == "block"
    assert found["/news/b3/x"].verdict == "allow" and found["/only-c/x"].template == "/*/x"


def test_deep_paths_are_not_cut(spark):
    """Branches part at any depth; a path of thousands of segments is named to its end."""
    deep, long = "a/b/c/d/e/f/g", "/x" * 20_000 + "/7"
    rules = (("site.net", f"/{deep}/spam/a", "block"), ("site.net", f"/{deep}/good/a", "allow"))
    urls = [f"http://site.net/{deep}/{part}/{leaf}" for part in ("spam", "good") for leaf in [f"a{i}" for i in range(30)] + ["blue"]]
    urls += [f"http://long.net{long}", f"http://long.net{long}", f"http://long.net{long}/y"]
    got = url_templates.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()
    found = {r.path: r for r in got}
    assert len(got) == len(urls)
    assert found[f"/{deep}/spam/blue"].verdict == "block" and found[f"/{deep}/good/blue"].verdict == "allow"
    assert found[f"/{deep}/spam/a3"].template == f"/{deep}/spam/*"
    assert found[long].template == long[:-1] + "*" and found[long + "/y"].template == long[:-1] + "*/y"


def test_branches_without_labels_inherit(spark):
    urls = [f"http://{host}/{part}/{i}" for host, parts in {
        "bad.com": {"de": 30, "en": 10}, "mixed.com": {"de": 30, "fr": 30, "en": 10}, "few.com": {"de": 2, "en": 10}, "none.net": {"de": 30, "en": 10},
        "deep.com": {"fr": 60, "de/x": 30}}.items() for part, n in parts.items() for i in range(n)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {(r.host, r.path): r for r in url_templates.filter_urls(pages).collect()}  # with the rules of the contract
    assert len(found) == len(urls)
    blocked = {r.host for r in found.values() if r.rule is None and r.verdict == "block"}
    assert blocked == {"bad.com"}
    assert all(r.verdict == "block" for r in found.values() if r.host == "bad.com")
    assert found["bad.com", "/en/1"].purity >= url_templates.PURITY > found["mixed.com", "/en/1"].purity
    # a spam section of a clean host: the nearest level decides
    rules = (("site.net", "/spam/a", "block"), ("site.net", "/news/a", "allow"))
    urls = [f"http://site.net/{part}/{leaf}" for part in ("spam", "news") for leaf in [f"a{i}/x" for i in range(30)] + ["blue", "green"]]
    found = {r.path: r for r in url_templates.filter_urls(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules).collect()}
    assert found["/spam/blue"].rule is None and found["/spam/blue"].verdict == "block"
    assert found["/news/blue"].rule is None and found["/news/blue"].verdict == "allow"


def test_texts_reach_the_models_as_arrow(spark):
    """As pandas a worker would hold all texts of a batch as strings at once, and pandas itself."""
    docs = spark.createDataFrame([(1, "a text")], "doc_id long, text string")
    language = langid.Model(["de"], np.zeros((1, 1)), np.zeros(1), 0.5, 1.0, 0.5)
    good = quality.Model({}, np.zeros(12), np.ones(12), np.zeros(12), 0.5)
    for scored in (langid.identify(docs, language), quality.evidence(docs, good, "p")):
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "ArrowEvalPython" in plan and str(ArrowUDFType.SCALAR) in plan.split("ArrowEvalPython")[1].split("\n")[0]


def test_kept_documents_are_scored_once(spark):
    """A filter on what follows from the score must not score each text again below the join."""
    docs = spark.createDataFrame([(i, f"plain text {i}" if i % 2 else f"!!! spamword {i} ???", "de", "web") for i in range(40)],
                                 "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    kept = quality.judge(docs, labels).where("judged.kept").select(*docs.columns)
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert {r.doc_id % 2 for r in kept.collect()} == {1}
