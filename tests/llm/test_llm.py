"""Operators of the training-data problems, on small fixtures against brute force."""

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import mixing, sentences, termfreq, tokenize, topn

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

# ---------------------------------------------------------------- 2: top n


def _top_by_hand(rows, n):
    best = {}
    for g, i, s, e in rows:
        if g is None or i is None:
            continue
        k = (-s, e is None, e if e is not None else 0, i)
        if (g, i) not in best or k < best[g, i]:
            best[g, i] = k
    groups = defaultdict(list)
    for (g, i), k in best.items():
        groups[g].append((k, i))
    return {(g, r, i) for g, items in groups.items() for r, (_, i) in enumerate(sorted(items)[:n], 1)}


@pytest.mark.parametrize("tasks", [1, 5, 1000])
def test_top_n(spark, tasks):
    rnd = random.Random(tasks)
    names = [None, "hot", "hot", "hot", "warm", *[f"g{i}" for i in range(30)]]
    rows = [(rnd.choice(names), rnd.choice([None, *[f"i{k}" for k in range(25)]]), float(rnd.randrange(6)), rnd.choice([None, 0.5, 1.5])) for _ in range(3000)]
    rows += rows[:50]
    df = spark.createDataFrame(rows, "g string, i string, s double, e double")
    order = [F.desc("s"), F.asc_nulls_last("e"), F.asc("i")]
    got = topn.top_n(df, "g", "i", order, 3, tasks=tasks)
    mine = [(r.g, r.rank_no, r.i) for r in got.collect()]
    assert len(mine) == len({*mine}) and {*mine} == _top_by_hand(rows, 3)
    assert topn.top_n(df.limit(0), "g", "i", order, 3, tasks=tasks).collect() == []


def test_heavy_groups_are_bounded(spark):
    df = spark.createDataFrame([(i % 10 if i < 900 else 77,) for i in range(1000)], "g int")
    assert topn.heavy_groups(df, "g", 9) == []
    assert topn.heavy_groups(df, "g", 10) == []
    assert topn.heavy_groups(df, "g", 11) == [77]
    assert topn.heavy_groups(df, "g", 12) == [77, *range(10)]
    assert topn.heavy_groups(df.limit(0), "g", 4) == []


@pytest.mark.parametrize("n", [3, 1500])
def test_a_group_of_half_the_rows_stays_split(spark, n):
    # No task of the last window may get more than the first n of every range.
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 997)).alias("g"), F.col("id").cast("string").alias("i"), (F.col("id") % 5000).cast("double").alias("s"))
    order = [F.desc("s"), F.asc("i")]
    hot = df.filter("g = 'hot'")
    ranges = hot.repartitionByRange(8, "g", *order)
    assert topn.first_of_ranges(ranges, "g", order, n).count() == (20_000 if n == 3 else 12_000)  # 8 ranges of 2,500 rows, cut to 1,500 each
    got = topn.top_n(df, "g", "i", order, n, tasks=8)
    if n == 3:
        assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    want = sorted(((-(k % 5000)), str(k)) for k in range(0, 40_000, 2))[:n]
    assert [r.i for r in got.filter("g = 'hot'").orderBy("rank_no").collect()] == [i for _, i in want]
    assert got.filter("g <> 'hot'").count() == sum(min(n, c) for c in Counter(k % 997 for k in range(1, 40_000, 2)).values())


# ---------------------------------------------------------------- 5: terms


def test_term_counts(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "t", "t", "t", "u", "v", ""]), rnd.choice([None, *[f"r{k}" for k in range(40)]])) for _ in range(2000)] + [("once", "r1")]
    df = spark.createDataFrame(rows, "term string, record string")
    n, records = Counter(), defaultdict(set)
    for t, r in rows:
        if t is not None and r is not None:
            n[t] += 1
            records[t].add(r)
    want = {t: (n[t], len(records[t])) for t in n}
    tokens = df.withColumn("kind", F.lit("k"))
    for tasks in (1, 4, 100):
        got = termfreq.term_counts(tokens, "kind", "term", "record", tasks)
        assert {r.term: (r.occurrences, r.n_records) for r in got.collect()} == want
        laid = termfreq.laid_out(tokens, "kind", "term", "record", tasks)
        assert laid.count() == sum(n.values()) > laid.distinct().count()  # repeated tokens reach the scan
    parts = {r.term: r.parts for r in laid.groupBy("term").agg(F.countDistinct("__part").alias("parts")).collect()}
    assert parts["once"] == 1 and parts["t"] > 20  # a heavy term is split
    marked = termfreq.mark(termfreq.term_counts(tokens, "kind", "term", "record"), "kind", {"k": 2}, {"k": ("1/2", "k")})
    assert {r.term: r.verdict for r in marked.collect()} == {t: "rare" if len(records[t]) < 2 else "common" if len(records[t]) * 2 > len(want) else None for t in want}
    assert termfreq.mark(termfreq.term_counts(tokens.limit(0), "kind", "term", "record"), "kind", {"k": 2}, {"k": ("1/2", "k")}).collect() == []


# ---------------------------------------------------------------- 6: encoding


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(VOCABULARY)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return tokenize.Encoder(tokenize.Vocabulary(VOCABULARY))


def _encode(encoder, text):
    return [i for w in encoder([text])[0] for i in encoder.memo[w]]


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]) | st.sampled_from("ab 'st\n"), max_size=60))
def test_ids_are_those_of_the_library(library, encoder, text):
    assert _encode(encoder, text) == library(text)


@pytest.mark.parametrize("text", ["a" * 70_001, "ab" * 5_000, " " * 3_000 + "x", "<|endoftext|>", "\n\n  <|endoftext|>x", "它们" * 4_000, "🧬" * 500, "I'll  we've 're", "\t \t"])
def test_long_and_special_texts(library, encoder, text):
    assert _encode(encoder, text) == library(text)


def test_encode_table(spark, library):
    rows = [(1, "Spin at 46 x g.", 5), (2, "", 5), (3, None, 5), (None, "x", 5), (1, "Spin at 46 x g.", 5), (4, " \n", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    for block in (1, 4_000_000):
        got = tokenize.encode(df, ["doc_id"], "text", VOCABULARY, block_chars=block).collect()
        assert sorted((repr(r.doc_id), [*r.ids]) for r in got) == sorted((repr(k), library(t or "")) for k, t, _ in rows)
    counts = tokenize.count_tokens(df, ["doc_id"], "text", VOCABULARY)
    assert sorted(r.n_tokens for r in counts.collect()) == sorted(len(library(t or "")) for _, t, _ in rows)
    assert tokenize.encode(df.limit(0), ["doc_id"], "text", VOCABULARY).collect() == []


def test_memo_may_be_dropped(library):
    small = tokenize.Encoder(tokenize.Vocabulary(VOCABULARY), memo_words=1)
    for t in ("one two three", "two three four five"):
        assert _encode(small, t) == library(t)


# ---------------------------------------------------------------- 7: mixing


def _mix_case(spark, seed, caps, weights, n=300):
    rnd = random.Random(seed)
    docs = [(k, rnd.choice(["a", "a", "a", "b", "c", "d", "other", None]), rnd.choice([None, 0, *range(1, 40)])) for k in range(n)]
    targets = [(s, w, c) for s, w, c in zip("abcde", weights, caps)]
    d = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame(targets, "source string, weight double, max_repeats int")
    return docs, targets, *mixing.mix(d, t)


@pytest.mark.parametrize(("seed", "caps", "weights"), [(1, (2, 2, 3, 1, 4), (0.2, 0.3, 0.3, 0.1, 0.1)), (2, (1, 1, 1, 1, 1), (0.01, 0.59, 0.2, 0.1, 0.1)), (3, (9, 0, 9, 9, None), (0.25, 0.25, 0.25, 0.25, 0.0)), (4, (1, 50, 1, 1, 1), (0.05, 0.9, 0.03, 0.02, 0.0))])
def test_mix(spark, seed, caps, weights):
    docs, targets, mixed, sizes = _mix_case(spark, seed, caps, weights)
    rows = mixed.orderBy("finish_time", "mix_end").collect()
    tokens = Counter()
    for _, s, n in docs:
        if s is not None and n is not None:
            tokens[s] += n
    listed = {s: (w, c or 0) for s, w, c in targets}
    budget = sum(n for s, n in tokens.items() if s in listed)
    # whole prefix of the queue, in order, within the budget
    assert [r.mix_end for r in rows] == [sum(x.n_tokens for x in rows[: i + 1]) for i in range(len(rows))]
    assert rows[-1].mix_end <= budget
    per_doc = Counter((r.doc_id, r.copy_no) for r in rows)
    assert max(per_doc.values()) == 1
    own = Counter()
    for r in rows:
        w, c = listed[r.source]
        assert w > 0 and 1 <= r.copy_no <= c
        own[r.source] += r.n_tokens
        assert abs(r.finish_time * w - own[r.source]) < 1e-6 * max(1, own[r.source])
    # nothing that could still come fits: the mix is short of the budget by less than the next document, or all is used
    capacity = sum(tokens[s] * c for s, (w, c) in listed.items() if w > 0)
    assert rows[-1].mix_end > budget - 40 or rows[-1].mix_end == min(budget, capacity)
    # a source that isn't exhausted has at least its weight of the tokens, but for the document under way
    report = {r.source: r for r in mixing.report(mixed, sizes).collect()}
    assert {s for s, r in report.items() if r.is_short} == {s for s, (w, c) in listed.items() if c * tokens[s] < w * budget}
    for s, r in report.items():
        assert r.mix_tokens == own[s]
        if not r.is_exhausted:
            assert r.mix_tokens >= listed[s][0] * rows[-1].mix_end - 40


def test_mix_of_nothing(spark):
    d = spark.createDataFrame([], "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame([("a", 1.0, 2)], "source string, weight double, max_repeats int")
    mixed, sizes = mixing.mix(d, t)
    assert mixed.collect() == []
    assert [(r.source, r.mix_tokens, r.is_short) for r in mixing.report(mixed, sizes).collect()] == [("a", 0, False)]
    mixed, sizes = mixing.mix(d, t.limit(0))
    assert mixed.collect() == [] and mixing.report(mixed, sizes).collect() == []


@pytest.mark.parametrize("few", [0, 1000])
def test_running_sum(spark, few, monkeypatch):
    monkeypatch.setattr(mixing, "SUM_ROWS", few)
    rnd = random.Random(9)
    rows = [(rnd.choice("xy"), k, rnd.randrange(10)) for k in range(500)]
    df = spark.createDataFrame(rows, "lane string, at int, v long").withColumn("part", F.floor(F.col("at") / 60).cast("int"))
    got = {(r.lane, r["at"]): r.total for r in mixing.running_sum(df, ["lane"], "part", ["at"], "v", "total").collect()}
    total = Counter()
    for lane, at, v in rows:
        total[lane] += v
        assert got[lane, at] == total[lane]


# ---------------------------------------------------------------- 8: sentences


def _split(text, corpus=()):
    starts, after = Counter(), Counter()
    for x in map(sentences.Scan, corpus):
        starts.update(x.starts)
        after.update(w for w, b in zip(x.words, x.bits) if b & sentences.JOINED in (0, sentences.STOP))
    know = [(sentences.FIRST, k, sentences.START) for k, n in starts.items() if n * 50 >= after[k]]
    return [text[a:b] for a, b in sentences.Splitter(sentences.Knowledge(know))(text)]


@pytest.mark.parametrize(
    "parts",
    [
        ["Spin at 46 x g for 67 min. at 4 °C.", "The ratio was .12 at first.", "On Monday Dr. Velkin left."],
        ["We stored tips, tubes, etc.", "Then they were lost."],
        ["As J. R. Tavish noted, it rose.", "We switched to plan B.", "The rest is history."],
        ['"Did it fail?" asked Ms. Quorrin.', 'The lid read "do not freeze!" and nobody saw it.', "She wrote: “They clump.”", "Why?!"],
        ["« Le tampon est-il périmé ? » demanda la technicienne.", "M. Tavrel a noté : « Les billes collent. »", "On passe au plan B."],
        ["„Ist er gut?“, fragte sie.", "Am 9. Mai wurde die Platte Nr. 3 gemessen.", "Z. B. fehlten 3 Barcodes.", "Das Gerät meldete: „Kein Signal.“", "Gut."],
        ["—¿Está limpio? —preguntó ella.", "¡No agiten la placa!", "Se perdió el 5,1 %, p. ej. en A."],
        ["Опыт повторили в 2005 г. на той же плате.", "Порог равен 9,9, см. табл. 9.", "«Буфер годен?» — спросила она."],
        ["Counts were low ... and then they rose.", "Hmm… the knee looks odd.", "It rose to 616,404.[8]", "(See Fig. 3B for the plot.)", "Some were lost (approx. 3!) during sorting."],
        ["The threshold is p < 3.1, as in Suppl. Fig. 6.", "Sec. 4.12.1 of the manual covers tags_37.Rmd.", "See https://a.b/qc.html?step=19 for it.", "Droplet.Sift v0.4.8 stopped."],
    ],
)
def test_sentences_of_cased_scripts(parts):
    assert _split(" ".join(parts)) == parts
    assert _split("\n".join(parts)) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["真的吗？！", "pH为7.4；好。", "仪器提示：“没有信号。”", "“失败了吗？”他问。", "很低……后来好了（见图2）。"],
        ["「失敗か？」と尋ねた。", "ｐＨは７．４で保った｡", "表示した：「信号なし。」", "終わり．"],
    ],
)
def test_sentences_of_scripts_without_spaces(parts):
    assert _split("".join(parts)) == parts


@pytest.mark.parametrize(
    "parts",
    [
        ["“क्या हुआ?” उसने पूछा।", "डॉ. वेल्किन ने रखी।", "उसने कहा, “ठीक है।”", "नली को मत हिलाइए!"],
        ["«هل فشل؟» سأل المشرف.", "قال: «صالح.»", "كانت ٧.٤ طوال التجربة.", "الشكل 49."],
        ['"실패했나요?"라고 물었다.', "pH는 7.4였다.", '장치는 "신호 없음."이라고 표시했다.'],
        ["ห้ามเขย่าหลอด", "พบเม็ด 36 เม็ดในชุด", "โปรแกรม beadcall อ่านไฟล์"],
    ],
)
def test_sentences_of_scripts_without_capitals(parts):
    assert _split(" ".join(parts)) == parts


def test_lists_blank_lines_and_wrapped_lines():
    text = "The steps are:\r\n1. Pool A\r\n2. Ask Dr. Velkin\r\n3) Spin.\r\n\r\n## Q&A\n \nIt stopped with code\n49. It went\non.\n- one\n- two; three\n* x\n\n\n"
    assert _split(text) == ["The steps are:", "1. Pool A", "2. Ask Dr. Velkin", "3) Spin.", "## Q&A", "It stopped with code\n49.", "It went\non.", "- one", "- two; three", "* x"]


def test_the_document_decides_before_the_corpus():
    # Unknown abbreviation: seen before a small letter in this document.
    assert _split("The qx. of A fell. See qx. Lund today.") == ["The qx. of A fell.", "See qx. Lund today."]
    assert _split("See the lund. Lund is here.") == ["See the lund.", "Lund is here."]
    # A name with a small first letter begins a sentence if it begins paragraphs elsewhere.
    assert _split("It ended. beadcall ran.", ["beadcall v1 ran.\n\nbeadcall v2 ran."]) == ["It ended.", "beadcall ran."]
    assert _split("It ended.The rest.", ["The one.", "The two."]) == ["It ended.", "The rest."]


@pytest.mark.parametrize("part", ["(", ")", '"', "a. ", "1. A ", "1. x\n", "(a. b) ", "“a.” ", "」", "... ", "[1]", "9. Mai "])
def test_time_grows_with_the_text(part):
    import time

    s = sentences.Splitter(sentences.Knowledge())
    t = time.time()
    s(part * (400_000 // len(part)))
    assert time.time() - t < 20


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB1.!?…。” “\"«»()„-—,;\n\r\t ก。؟अ।") | st.characters(exclude_categories=["Cs"]), max_size=60))
def test_places_are_ordered_and_complete(text):
    e = sentences.Splitter(sentences.Knowledge())
    places = e(text)
    at = 0
    for a, b in places:
        assert at <= a < b <= len(text)
        assert text[at:a].strip(sentences.WHITE_SPACE) == ""
        assert text[a:b] == text[a:b].strip(sentences.WHITE_SPACE)
        at = b
    assert text[at:].strip(sentences.WHITE_SPACE) == ""


@pytest.mark.parametrize("copies", [3, 99, 100, 400])
def test_a_common_word_is_no_abbreviation(spark, copies):
    rows = [(k, f"We washed the cells. Then we stored tube {k} again.") for k in range(copies)]
    got = sentences.sentences(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], "text")
    assert got.count() == 2 * copies


def test_the_corpus_shows_abbreviations_before_names(spark):
    rows = [(k, "We saw Capt. Velkin today. We asked Velkin again.") for k in range(100)]
    got = sentences.sentences(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], "text")
    assert got.count() == 200


def _places(spark, rows, **more):
    got = sentences.sentences(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"], "text", **more)
    return sorted((r.doc_id, r.start_at, r.end_at) for r in got.collect())


def test_a_larger_corpus_splits_the_same(spark):
    from tallyloom.plans.tables import read

    texts = [r.text for r in read(spark, "/root/testdata/sf0.001", "documents").collect()]
    texts += ["zorptool v1 ran.", "It ended. zorptool ran.", "See Tab. Lund. It fell.", "Ask Zx. Lund now. Lund left."]
    n = len(texts)
    once = _places(spark, [*enumerate(texts)])
    many = _places(spark, [(k + n * copy, t) for copy in range(3) for k, t in enumerate(texts)])
    assert many == sorted((d + n * copy, a, b) for copy in range(3) for d, a, b in once)
    assert [(a, b) for d, a, b in once if d == n - 3] == [(0, 9), (10, 23)]


def test_more_keys_than_are_broadcast(spark):
    # 60,000 words that begin sentences and as many abbreviations; one is in every text.
    def word(k, ending=""):
        return "".join(chr(97 + int(d)) for d in f"{k:05d}") + ending

    rows = [(k, f"The qq. of {word(k, 'z')} fell. {word(k)} ran {word(k, 'x')}. of it.\n\n{word(k)} ended. Then {word(k)} rose. {word(k)} fell, see {word(k, 'x')}. Lund.") for k in range(60_000)]
    want = [["The qq. of", "fell."], ["ran", "of it."], ["ended."], ["Then", "rose."], ["fell, see", "Lund."]]
    got = sentences.sentences(spark.createDataFrame(rows, "doc_id long, text string").repartition(8), ["doc_id"], "text")
    texts = dict(rows)
    found = {}
    for r in got.collect():
        found.setdefault(r.doc_id, []).append((r.start_at, texts[r.doc_id][r.start_at : r.end_at]))
    assert len(found) == len(rows)
    for places in found.values():
        parts = [t for _, t in sorted(places)]
        assert len(parts) == 5 and all(p.startswith(w[0]) or w[0] in p for p, w in zip(parts, want)) and all(p.endswith(w[-1]) for p, w in zip(parts, want)), parts


def test_the_order_is_document_corpus_lists(spark):
    # "dr" is listed as an abbreviation; this corpus shows that it ends sentences, and one document does.
    doctor = [(k, "She saw a dr. We saw another dr.\n\nThey like the dr.") for k in range(50)]
    assert len(_places(spark, doctor)) == 150
    assert len(_split("She saw a dr. We left.")) == 1  # nothing known: the list
    assert len(_split("She saw a dr. We left. He saw the dr.\n\nAll is well.")) == 4  # the document
    assert len(_split("The qx. of A fell. See qx. Lund today.")) == 2


def test_runs_without_spaces(spark):
    import time

    for part in ("A.B.", "A.", "x.Y", "。A.", "A!B", "«A.» ", "1.A"):
        t = time.time()
        sentences.Splitter(sentences.Knowledge())(part * 100_000)
        assert time.time() - t < 20, part


def test_sentence_table_both_ways(spark):
    texts = ["Ask Dr. Velkin. He left.", "", None, "  \n\n", "beadcall ran.\n\nbeadcall ended. beadcall ran.", "One.\n\n" * 50 + "x" * 100_000 + ". End."]
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(0, texts[0], 1), (None, "A bee. C dee.", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start_at int")
    results = []
    for bound in (10_000, 3, 0):
        got = sentences.sentences(df, ["doc_id"], "text", broadcast_keys=bound)
        results.append(sorted((repr(r.doc_id), r.sentence_no, r.start_at, r.end_at) for r in got.collect()))
    assert results[0] == results[1] == results[2]
    assert [r[2:] for r in results[0] if r[0] == "None"] == [(0, 6), (7, 13)]
    assert sum(r[0] == "0" for r in results[0]) == 4
    assert sentences.sentences(df.limit(0), ["doc_id"], "text").collect() == []


# ---------------------------------------------------------------- columns with names that operators use


def test_clashing_names(spark):
    rows = [("g", "a", 1.0, None, 7, 7), ("g", "b", 2.0, None, 7, 7)]
    df = spark.createDataFrame(rows, "g string, i string, s double, e double, rank_no int, __k int")
    got = topn.top_n(df, "g", "i", [F.desc("s"), F.asc("i")], 1, tasks=9)
    assert [(r.i, r.rank_no) for r in got.collect()] == [("b", 1)]
    docs = spark.createDataFrame([(1, "a", 5, 1, 1.0, 1)], "doc_id long, source string, n_tokens long, copy_no int, weight double, tokens int")
    targets = spark.createDataFrame([("a", 1.0, 2, 3)], "source string, weight double, max_repeats int, n_docs int")
    mixed, _ = mixing.mix(docs, targets)
    assert [(r.doc_id, r.copy_no, r.mix_end) for r in mixed.collect()] == [(1, 1, 5)]
    texts = spark.createDataFrame([(1, "One. Two.", "x", "y")], "doc_id long, text string, __text string, sentence_no string")
    assert sentences.sentences(texts, ["doc_id"], "text").count() == 2
    assert tokenize.encode(texts, ["doc_id"], "text", VOCABULARY).count() == 1
    terms = spark.createDataFrame([("t", "r", 1, "k")], "term string, record string, weight int, kind string")
    assert termfreq.term_counts(terms, "kind", "term", "record").first().n_records == 1


def test_mix_with_one_source_of_a_third_of_many_rows(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("source"), (F.col("id") % 17 + 1).alias("n_tokens"))
    names = [r[0] for r in docs.select("source").distinct().collect()]
    targets = spark.createDataFrame([(s, 1 / len(names), 3) for s in names], "source string, weight double, max_repeats int")
    mixed, sizes = mixing.mix(docs, targets)
    total = sum(r["tokens"] for r in sizes)
    assert total - 20 < mixed.agg(F.max("mix_end")).first()[0] <= total
    assert mixed.agg(F.sum("n_tokens")).first()[0] == mixed.agg(F.max("mix_end")).first()[0]


def test_mix_without_ids_is_repeatable(spark):
    docs = spark.createDataFrame([(None, "a", n) for n in range(1, 200)] + [(5, "a", 3), (5, "a", 4), (5, "a", 4)], "doc_id long, source string, n_tokens long")
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, weight double, max_repeats int")
    runs = [sorted((r.n_tokens, r.mix_end) for r in mixing.mix(docs.repartition(k), targets)[0].collect()) for k in (1, 5)]
    assert runs[0] == runs[1] and len(runs[0]) == 202
