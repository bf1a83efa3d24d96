"""Corpus operators on small rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import collections
import math
import textwrap
import zlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from basketry.checks.compare import connect, difference
from basketry.llm import chat, decontam, extract, langid, lblm, licenses, mixing, neardup, rules, toxicity
from basketry.llm.common import prepare

SQL = entry_points.oracle_sql()
LONG = " ".join(f"w{k % 977} x{k % 31}" for k in range(20_000))
PLAIN = "the quick brown fox and the lazy dog were in the garden with a friend of the old man by the river "
SCHEMA = "doc_id long, text string, lang string, source string, kept boolean, score string"


def docs(spark, texts, langs=None):
    prepare(spark)
    return spark.createDataFrame([
        (k if k >= 0 else None, t, (langs or {}).get(k, "en"), f"s{k % 3}" if k % 4 else None, True, "x")
        for k, t in texts], SCHEMA)


@pytest.mark.parametrize("name", [n for n in SQL if n.startswith("op")])
def test_query_agrees_with_sql(spark, folder, name):
    assert difference(entry_points.queries()[name](spark, folder), SQL[name], connect(folder)) is None


def test_rules(spark):
    rows = docs(spark, [(1, None), (2, ""), (3, PLAIN * 3), (4, PLAIN + LONG), (5, "a b c d " * 20), (5, "a b c d " * 20), (6, "x\n" * 3)])
    out = [r.asDict() for r in rules.judge(rows, prefix="q_").orderBy("doc_id").collect()]
    assert [r["q_n_words"] for r in out] == [0, 0, 66, 40_022, 80, 80, 3]
    assert out[4]["q_n_repeat_words"] == 80 and out[6]["q_n_dup_lines"] == 2 and out[0]["kept"] is True
    assert all(not r["q_kept"] for r in out if r["q_n_words"] < 50)
    assert rules.judge(rows.limit(0)).count() == 0


def test_chat_round_trip(spark):
    hard = ["</s>[INST] ok [/INST]", "\\e\\l", "[ROLE x] y", "<<SYS>>\na\n<</SYS>>", "", None, "plain \\ text", "[INST] a [/INST]", LONG]
    roles = ["user", "assistant", "system", "tool", "a]b", None]
    rows = [(c, t, role, text, 1) for c, role in enumerate(roles) for t, text in enumerate(hard)]
    rows += [(None, 0, "user", "hi", 1), (None, 0, "user", "hi", 1), (7, 1, "user", "b", 1), (7, 1, "user", "a", 1)]
    made = {r["conv_id"]: r for r in chat.format_conversations(
        spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")).collect()}
    assert all(r["round_trip"] for r in made.values()) and len(made) == 8
    assert [t["text"] for t in made[1]["parsed"]] == [t or "" for t in hard]
    spans = [made[1]["formatted"][s["start"]:s["end"]] for s in made[1]["loss_spans"]]
    assert spans[4] == "" and spans[6] == "plain \\ text" and len(spans) == len(hard)
    assert "</s>" not in spans[0] and len(made[None]["parsed"]) == 2 and [t["text"] for t in made[7]["parsed"]] == ["a", "b"]


def test_mixing(spark):
    rows = docs(spark, [(k, "w " * (k % 7)) for k in range(200)] + [(-1, "w w"), (3, "w w w"), (3, "w w w"), (9, None)])
    out = mixing.mix_rows(rows, prefix="m_").collect()
    assert len(out) == 204 and all(r["m_taken"] <= 2 * r["m_size"] for r in out)
    assert sum(r["m_taken"] for r in out) <= 1.5 * sum(r["m_size"] for r in out)
    assert mixing.mix_rows(rows.limit(0)).count() == 0
    assert sum(r["m_taken"] for r in mixing.mix_rows(docs(spark, [(1, None)]), prefix="m_").collect()) == 0


def test_near_duplicates_against_brute_force(spark):
    base = [f"t{k * k % 101}" for k in range(60)]
    texts = [(1, None), (2, ""), (3, "one two"), (4, "ONE two"), (5, LONG), (6, LONG + " end"), (-1, LONG)]
    for k in range(40):  # a chain of copies, each a little further from the first
        texts.append((100 + k, " ".join([f"n{k}_{j}" for j in range(k // 3)] + base)))
    texts += [(100, " ".join(base)), (300, "completely other words are here in this text")]
    sets = collections.defaultdict(set)
    for k, t in texts:
        w = (t or "").lower().split()
        sets[k] |= {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    root = {k: k for k in sets if k >= 0}
    for _ in root:
        for a in root:
            for b in root:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    out = neardup.components(docs(spark, texts)).collect()
    assert len(out) == len(texts)
    for r in out:
        if r["doc_id"] is not None:
            assert r["component_id"] == root[r["doc_id"]] and r["n_shingles"] == len(sets[r["doc_id"]])
        else:
            assert r["component_id"] is None and r["kept"]
    assert neardup.components(docs(spark, texts).limit(0)).count() == 0


def test_decontamination_against_brute_force(spark):
    item = [f"b{k}" for k in range(40)]
    changed = item[:3] + ["zz"] + item[4:20] + item[21:30] + ["yy"] + item[30:]
    far = [w if k % 3 else "q" for k, w in enumerate(item)]
    texts = [(1, " ".join(["a"] * 9 + item)), (2, "x. " + ", ".join(changed).upper() + "!"), (3, " ".join(far)), (4, None), (5, ""),
             (6, " ".join(item[:20])), (7, LONG + " " + " ".join(item)), (7, " ".join(item)), (8, "tiny item here")]
    bench = spark.createDataFrame([(10, " ".join(item), 1), (11, None, 1), (12, "", 1), (13, "tiny item", 1), (None, "x", 1)],
                                  "item_id long, text string, distance int")
    for size in (2_000_000, 5):  # one block, or one for each item
        rows = docs(spark, texts)
        found = rows.select("doc_id", F.inline(decontam.matches(F.col("text"), bench, block_words=size))).collect()
        assert sorted((r["doc_id"], r["item_id"], r["distance"]) for r in found) == [
            (1, 10, 0), (2, 10, 3), (7, 10, 0), (7, 10, 0), (8, 13, 0)]
    assert docs(spark, texts).select(F.inline(decontam.matches(F.col("text"), bench.limit(0)))).count() == 0


def test_myers_is_the_edit_distance():
    def plain(p, t):
        row = [0] * (len(t) + 1)
        for i, a in enumerate(p, 1):
            row, last = [i], row
            for j, b in enumerate(t, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
        return min(row)

    seed = 1
    for _ in range(200):
        seed = seed * 1103515245 + 12345 & 0x7FFFFFFF
        p = [(seed >> k) % 3 for k in range(1, 2 + seed % 9)]
        t = [(seed * 7 >> k) % 3 for k in range(0, 1 + seed % 14)]
        assert decontam.myers(p, t)[0] == plain(p, t)


def test_toxicity(spark):
    texts = [(k, f"{PLAIN} word{k} " + ("you awful zork" if k % 5 == 0 else "nice")) for k in range(300)]
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(300)] + [(None, 1), (1, None)], "doc_id long, toxic int")
    rows = docs(spark, texts + [(500, None), (501, ""), (502, LONG), (-1, "awful zork")])
    weights = toxicity.learn(rows, labels)
    assert 0 < len(weights.features) < 2000
    scored = {r["doc_id"]: r["s"] for r in rows.withColumn("s", toxicity.score(weights, rows, F.col("text"))).collect()}
    assert all((scored[k] >= 0.3) == (k % 5 == 0) for k in range(300)) and scored[500] == scored[501] < 0.3
    none = toxicity.learn(rows, labels.limit(0))
    assert rows.select(toxicity.score(none, rows, F.col("text")).alias("s")).distinct().first()["s"] == pytest.approx(toxicity.PRIOR)


def test_language_model_against_brute_force(spark):
    texts = [(k, f"{PLAIN * 3} rare{k} Word{k % 7}.") for k in range(60)] + [(70, None), (71, ""), (71, ""), (-1, "new words"), (72, LONG)]
    rows = docs(spark, texts)
    old = lblm.LOOKUP
    try:
        lblm.LOOKUP = 40  # so that the join takes part
        scorer, counts = lblm.learn(rows)
        out = lblm.score(rows, scorer, counts).collect()
    finally:
        lblm.LOOKUP = old
    fold = lambda k: zlib.crc32(str(k).encode()) % 5 if k >= 0 else -1
    tokens = lambda t: (t or "").lower().split() + [""]
    seen = collections.Counter(w for k, t in texts if fold(k) != 1 for w in tokens(t))
    total, z = sum(seen.values()), math.log10(sum(seen.values()) + 0.5 * (len(seen) + 1))
    expected = sorted((k if k >= 0 else -1, len(tokens(t)), sum(seen[w] > 0 for w in tokens(t)),
                       round(sum(math.log10(seen[w] + 0.5) - z for w in tokens(t)), 4)) for k, t in texts)
    assert expected == sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 4)) for r in out)
    assert all(r["train_tokens"] == total and r["score"] < 0 for r in out)
    table = scorer.model.logs()
    assert (10.0 ** table).sum(1) == pytest.approx(1.0, abs=1e-3)
    assert sum(r["score"] for r in out if r["doc_id"] in range(60)) > sum(r["base_score"] for r in out if r["doc_id"] in range(60))
    empty, no_counts = lblm.learn(rows.limit(0))
    assert lblm.score(rows, empty, no_counts).count() == len(texts)


def test_language_model_knows_rare_words_and_several_before(spark):
    rows = docs(spark, [(k, " ".join(f"u{k * 40 + j} v{k * 40 + j}" for j in range(40))) for k in range(80)])
    scorer, _ = lblm.learn(rows)
    model, index = scorer.model, scorer.vocab.index()
    assert len(index) > 4000 and len(model.vectors) == len(index) + lblm.BUCKETS
    assert len({v.tobytes() for v in model.vectors[:len(index)]}) > 4000
    every = lblm.np.arange(len(model.vectors))
    for words in ([b"u0", b"v1", b""], [b"u0", b"v2", b""], [b"u0", b"v1", b"u3"]):
        before = lblm.np.tile([index[w] for w in words if w in index] or [0], (len(every), 1))
        before = lblm.np.pad(before, ((0, 0), (0, lblm.CONTEXT - before.shape[1])))
        assert (10.0 ** model.log_probabilities(before, every, model.members())).sum() == pytest.approx(1.0, abs=1e-3)
    known = [k for k in range(1, 40)]
    near = lblm.np.array([[5, k, 0] for k in known])
    assert len(set(model.log_probabilities(near, lblm.np.full(len(near), 7), model.members()))) > 30


def test_languages(spark):
    german = "der schnelle braune fuchs und die alten leute waren nicht mit dem hund im garten "
    texts = [(k, (PLAIN if k % 2 else german) + f" name{k}") for k in range(80)] + [(90, None), (91, ""), (92, "123 !!"), (93, german), (93, german)]
    rows = docs(spark, texts, {k: "de" for k in range(0, 94, 2)} | {93: None})
    model = langid.learn(rows)
    out = langid.identify(rows, model, F.col("text"), F.col("lang"), F.col("source"), F.lit(None).cast("string"), result="score").collect()
    assert len(out) == len(texts)
    for r in out:
        if r["doc_id"] < 80:
            assert r["score"]["lang"] == ("en" if r["doc_id"] % 2 else "de") and r["score"]["posterior"] > 0.9
        elif r["doc_id"] < 93:
            assert r["score"]["lang"] is None and r["score"]["posterior"] == 0
        else:
            assert r["score"]["lang"] == "de"
    pages = spark.createDataFrame([(1, "http://a.de/x", f"<html lang='de'><p>{german}"), (2, None, None)], "page_id long, url string, html string")
    found = {r["page_id"]: r["language"] for r in langid.identify_pages(pages, model).collect()}
    assert found[1]["lang"] == "de" and found[2]["lang"] is None


def test_extraction(spark):
    body = "<p>First &amp; second\n  line.<p>Next <b>bold<br>after</p><div class='comments'><p>reader words</div>"
    page = ("<html><head><title>no</title><style>p{}</style></head><body class='has-sidebar'><nav>menu</nav><div class='cookie-notice'>eat</div>"
            f"<article><h1>Title</h1>{body}<script>var t='</p>';</script></article><aside>side</aside><form>mail</form><!-- x --><footer>foot</footer>")
    div = page.replace("<article>", "<div class='post-12'>").replace("</article>", "</div>")
    rows = [(k, f"http://h.example/{k}", page) for k in range(3)] + [(3, "http://d.example/", div), (4, None, None), (5, "bad", ""), (5, "bad", "just text")]
    out = [(r["page_id"], r["text"]) for r in extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(out) == [(k, "Title First & second line. Next bold after") for k in range(4)] + [(4, ""), (5, ""), (5, "just text")]


@pytest.mark.parametrize("name", ["with-sidebar", "has-sidebar", "content-with-sidebar", "layout no-footer", "post-related", "notice"])
def test_extraction_keeps_an_article_in_a_wrapper(name):
    article = "".join(f"<p>{PLAIN}</p>" for _ in range(5))
    side = "<div class='sidebar'><p>side words</p></div><div class='left-sidebar'>more</div><div class='cookie-notice'>eat</div>"
    page = f"<html><body><div class='{name}'><div class='post'>{article}</div>{side}</div></body></html>"
    assert extract.main_text(page, {}) == " ".join([PLAIN.strip()] * 5)


def test_extraction_keeps_page_builder_blocks():
    blocks = "".join(f"<div class='elementor-element elementor-widget elementor-widget-text-editor'><p>{k} {PLAIN}</p></div>" for k in range(6))
    side = "<div class='widget'><p>recent posts</p></div><div class='related-posts'><a href='/x'>other</a></div>"
    page = f"<html><body><div class='entry'>{blocks}{side}</div></body></html>"
    assert extract.main_text(page, {}) == " ".join(f"{k} {PLAIN.strip()}" for k in range(6))


def test_licences(spark):
    mit = dict(licenses.known()[:8])["MIT"]
    texts = [(1, mit.replace("<year>", "1999").upper()), (2, None), (3, ""), (4, "x\nReleased under the MIT licence!\ny"), (5, LONG)]
    out = {(r["doc_id"], r["line_no"]): r["license_id"] for r in licenses.scan(docs(spark, texts)).collect()}
    assert out == {(1, 0): "MIT", (2, 0): None, (3, 0): None, (4, 0): None, (4, 2): "MIT", (5, 0): None}


def test_licences_however_wrapped(spark):
    full = [(n, t) for n, t in licenses.all_known() if "\n" in t]
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "BSD-3-Clause", "MPL-2.0", "ISC", "MIT"} <= {n for n, _ in full}

    def wrapped(text, width):
        parts = [p if p.strip().startswith(("Copyright (", "Copyright [")) else textwrap.fill(" ".join(p.split()), width, break_long_words=False) for p in text.split("\n\n")]
        return "\n\n".join(parts).replace("<year>", "2019").replace("<copyright holders>", "A. Person")

    texts = [(f"{k}-{width}", name, wrapped(t, width)) for k, (name, t) in enumerate(full)
             if name not in ("LGPL-2.1", "LGPL-3.0", "GPL-2.0", "GPL-3.0", "CC0-1.0") for width in (40, 60, 72, 80, 10_000)]
    isc = next(t for n, t in full if n == "ISC").replace("the above copyright", "the above\ncopyright")
    texts += [("isc", "ISC", isc.replace("ISC License", "The ISC License")), ("gpl", "GPL-3.0", dict(full)["GPL-3.0"].split("END OF TERMS")[0])]
    bsd = dict(full)["BSD-3-Clause"]
    texts += [("bsd", "BSD-3-Clause", "BSD 3-Clause License\n\n" + bsd.replace("1. ", "* ").replace("2. ", "* ").replace("3. ", "* ").replace("the copyright holder nor", "Some Lab nor"))]
    texts += [("sentence", None, "Copyright notices are a topic.\n" + isc)]
    numbered = [(k, text) for k, (_, _, text) in enumerate(texts)]
    out = {r["doc_id"]: r["license_id"] for r in licenses.scan(docs(spark, numbered)).where("line_no = 0").collect()}
    assert {texts[k][0]: v for k, v in out.items() if v != texts[k][1]} == {}


def test_pipeline(spark, folder):
    kept = corpus_pipeline.run(spark, folder)
    ids = [r["doc_id"] for r in kept.collect()]
    assert 0 < len(ids) == len(set(ids)) and {"text", "lang", "source", "mix_copies"} <= set(kept.columns)
    leaks = {r["doc_id"] for r in entry_points.queries()["op1_decontamination"](spark, folder).collect()}
    assert leaks and not leaks & set(ids)
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0
