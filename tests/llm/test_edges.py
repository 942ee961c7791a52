"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from readframe.llm import bpe, chat, decontaminate, hmm, jaccard, langid, quality, records, toxicity, urls
from readframe.session import scratch_path

LONG = " ".join(random.Random(5).choice(["alpha", "beta", "gamma", "delta", "x1"]) for _ in range(30_000))
TEXTS = [None, "", " \n\t", "one", "One two three", "same text here now", "same text here now", LONG, "é ü 日本語 \x00 🎉", "a" * 5_000]


@pytest.fixture(scope="module")
def docs(spark):
    """Texts with a null id, repeated rows, and extra columns named like the operators' own."""
    rows = [(i, t, "kept", 1.5) for i, t in enumerate(TEXTS)] + [(None, "no id", "kept", 0.0), (5, "same text here now", "kept", 1.5)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, score string, n double")


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("false")


def test_bpe(spark, docs, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    found = coded.collect()
    assert len(found) == len(TEXTS) + 2
    for r in found:
        want = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert bytes(r.decoded) == want.encode() and r.n_tokens == len(r.ids) // 4
    back = {r.doc_id: bytes(r.decoded) for r in bpe.decode(coded, path).collect()}
    assert back[9] == TEXTS[9].encode() and back[0] == b""
    assert bpe.encode(none, path, public_tokenizers.PATTERN).count() == 0
    with pytest.raises(ValueError):
        bpe.merge_rows({b"a": 0, b"b": 1, b"c": 2, b"abc": 3})


@pytest.mark.parametrize("word", ["a" * 700, "abcabcb" * 120, "你好世界" * 90, "".join(random.Random(1).choices("abcde", k=900))])
def test_long_words_as_the_library(word):
    import tiktoken

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    import regex

    con, tokens = bpe._connection(), [(r, t) for t, r in ranks.items()]
    (ids,) = bpe.Contractor(con, bpe.merge_rows(ranks), tokens).encode([word], regex.compile(public_tokenizers.PATTERN).findall)
    assert ids.tolist() == library.encode_ordinary(word) and bpe.Decoder(con, tokens).decode([ids[:0], ids]) == [b"", word.encode()]


def test_language(spark, docs, none):
    taught = [(i, "the cat sat on the mat and the dog ran " * 3, "en") for i in range(30)]
    taught += [(i + 100, "der hund und die katze sind nicht im haus " * 3, "de") for i in range(30)] + [(200, "no label", None)]
    model = langid.fit(spark.createDataFrame(taught, "doc_id bigint, text string, lang string"))
    found = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert found[0].lang_pred == found[1].lang_pred == found[2].lang_pred == "und" and found[0].score == 0
    assert found[3].lang_pred in ("en", "de") and all(0 <= r.score <= 1 for r in found.values())
    assert langid.identify(none, model).count() == 0
    kept = langid.keep(docs, model)
    assert kept.columns == docs.columns and kept.filter("doc_id < 3").count() == 0
    empty = langid.fit(none.select("doc_id", "text", F.lit("en").alias("lang")))
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"}


def test_language_rejects_what_it_has_not_learned(spark):
    from readframe.llm.common import table

    docs = table(spark, "/root/testdata/sf0.001", "documents")
    texts = [
        "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto",
        "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem",
        " ".join("".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyz", k=6)) for i in range(80)),
    ]
    model = langid.fit(docs)
    assert all(model.nearest(t)[2] for t in texts)
    long = [r.text for r in docs.filter("length(text) > 500").collect()]
    assert sum(model.nearest(t)[2] for t in long) <= 0.02 * len(long)
    # A language that is left out goes, also where another has few labelled texts.
    few = docs.filter("lang = 'es' OR (lang = 'de' AND doc_id % 5 = 0) OR (lang = 'en' AND doc_id % 5 = 0)")
    model = langid.fit(few)
    french = [r.text for r in docs.filter("lang = 'fr'").collect()]
    assert sum(model.nearest(t)[2] for t in french) >= 0.9 * len(french)


def test_chat(spark):
    rows = [
        (1, 0, "user", "a\\b <\\l> ### user: </turn>\n"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, None, "x"),
        (None, 3, "us:er", " </turn>\n### "), (2, 5, "assistant", "hi"), (2, 6, "user", "\\"),
    ] + [(3, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(600)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("loss", F.lit("clash"))
    segments = chat.format_chats(turns)
    back = {r.conv_id: r for r in chat.read_back(segments).collect()}
    assert [tuple(t) for t in back[1].turns] == [("", "x"), ("user", rows[0][3]), ("assistant", ""), ("assistant", "")]
    assert [tuple(t) for t in back[None].turns] == [("us:er", " </turn>\n### ")]
    assert [t.text for t in back[3].turns] == [f"t{i}" for i in range(600)]
    assert {c: r.n_bad_turns for c, r in back.items()} == {1: 3, None: 1, 2: 2, 3: 0}
    assert back[3].loss_text == "".join(f"t{i}" for i in range(1, 600, 2))
    ok = {(r.conv_id, r.turn_no): r.turn_ok for r in segments.select("conv_id", "turn_no", "turn_ok").distinct().collect()}
    assert all(ok[3, i] for i in range(600)) and not ok[2, 0] and not ok[2, 1] and not ok[1, 3]
    assert chat.read_back(chat.format_chats(turns.filter("false"))).count() == 0
    with pytest.raises(ValueError):
        chat.Template(after="end")


def test_urls(spark):
    entries = spark.createDataFrame(
        [("l", "bad.org", "block", 10), ("l", "bad.org", None, 20), ("l", "ok.bad.org", "allow", 5), ("m", "bad.org", "allow", 12),
         ("l", "x.net/a", "block", 0), ("l", "x.net/a", "block", 400), (None, "x.net", "block", 0), ("l", "x.net", "block", None)],
        "list string, key string, verdict string, day bigint",
    )
    captures = spark.createDataFrame(
        [(1, "http://bad.org/p", 9), (2, "http://bad.org/p", 10), (2, "http://bad.org/p", 10), (3, "http://bad.org", 20),
         (4, "https://u@OK.bad.org:80/", 500), (5, "http://x.net/a/b?q", 900), (6, "http://x.net/ab", 900), (7, None, 1),
         (8, "not a url", 1), (9, "http://bad.org", None)],
        "page_id bigint, url string, day bigint",
    ).withColumn("list", F.lit("clash")).withColumn("key", F.lit("clash"))
    found = urls.evaluate(captures, entries)
    got = sorted((r.page_id, r._verdict) for r in found.collect())
    assert got == [(1, "none"), (2, "block"), (2, "block"), (3, "allow"), (4, "allow"), (5, "block"), (6, "none"), (7, "none"),
                   (8, "none"), (9, "none")]
    assert {r._verdict for r in urls.evaluate(captures, entries.filter("false")).collect()} == {"none"}
    clashing = captures.withColumns({c: F.lit("own") for c in ("_url", "_day", "_f", "_verdict", "_key", "row", "_period")})
    told = urls.evaluate(clashing, entries)
    assert told.columns == [*clashing.columns, "__verdict", "__key", "_list"]
    assert sorted((r.page_id, r["__verdict"]) for r in told.collect()) == got
    assert urls.evaluate(captures.filter("false"), entries).count() == 0


def repeated(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            hit |= {i, i + 1, i + 2}
    return len(hit)


def test_quality(spark, docs, none):
    found = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert found[0].n_words == found[2].n_words == 0 and not found[0].kept and found[0].base_failed
    assert found[7].n_words == 30_000 and found[7].n_repeat_words > 29_000
    texts = [" ".join(random.Random(i).choices("abcdefgh", k=i)) for i in range(2, 60, 3)]
    rows = quality.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.n_repeat_words for r in rows} == {i: repeated(t.split()) for i, t in enumerate(texts)}
    assert quality.judge(none).count() == 0
    assert quality.keep(docs).columns == docs.columns


def test_quality_finds_the_bad_class(spark):
    good = [" ".join(f"{random.Random(i * 1000 + j).choice(['stone', 'river', 'light', 'house'])}{chr(97 + j % 20)}" for j in range(150)) for i in range(90)]
    bad = [" ".join(f"wo{chr(97 + (i + j) % 26)}{chr(97 + j % 23)}###" for j in range(150)) for i in range(10)]
    judged = quality.judge(spark.createDataFrame(list(enumerate(good + bad)), "doc_id bigint, text string")).collect()
    assert {r.doc_id for r in judged if not r.kept} == set(range(90, 100))


def test_hmm(spark, docs, none):
    found = hmm.score(docs, F.col("doc_id") % 2 == 1, rounds=2).collect()
    assert len(found) == len(TEXTS) + 2 and all(math.isfinite(r.score) and r.score < 0 or r.n_tokens == 1 for r in found)
    assert next(r for r in found if r.doc_id is None).held_out
    assert hmm.score(none, F.lit(False)).count() == 0
    untrained = hmm.score(docs, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in untrained)


def test_hmm_likelihood_is_exact():
    model = hmm.Parameters.first()
    rng = np.random.default_rng(3)
    lens = np.array([1, 64, 65, 200, 3])
    classes = rng.integers(0, hmm.CLASSES, lens.sum())
    want, at = [], 0
    for n in lens:
        state, log = model.start, 0.0
        for t, c in enumerate(classes[at : at + n]):
            state = (state if t == 0 else state @ model.move) * model.emit[:, c]
            log += math.log10(state.sum())
            state = state / state.sum()
        want.append(log)
        at += n
    assert np.allclose(model.log10(classes, lens), want)


def test_hmm_counts_raise_the_likelihood():
    rng = np.random.default_rng(4)
    lens = np.full(40, 50)
    classes = np.concatenate([rng.integers(0, 20, 50) + 100 * (i % 2) for i in range(40)])
    model, before = hmm.Parameters.first(), -np.inf
    for _ in range(4):
        now = model.log10(classes, lens).sum()
        assert now > before
        before, total = now, np.zeros((hmm.STATES, hmm.STATES + hmm.CLASSES + 2))
        model.expected(classes, np.cumsum(lens) - lens, lens, total)
        model = hmm.Parameters.from_counts(total)


def test_toxicity(spark, docs, none):
    rows = [(i, f"plain words about number {i} and more plain words " * 3 + ("vile rotten vile " if i % 4 == 0 else "")) for i in range(200)]
    taught = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(120)] + [(None, 1), (3, None)], "doc_id bigint, toxic int")
    found = {r.doc_id: r.score for r in toxicity.score(taught, labels).collect()}
    assert all((found[i] >= 0.3) == (i % 4 == 0) for i in range(120, 200))
    scores = toxicity.score(docs, labels).collect()
    assert len(scores) == len(TEXTS) + 2 and all(0 <= r.score <= 1 for r in scores)
    assert {r.score for r in toxicity.score(docs, labels.filter("false")).collect()} == {0.5}
    assert toxicity.score(none, labels).count() == 0


def test_toxicity_of_rare_words(spark):
    """Words seen in a few labelled texts only tell held-out texts apart, among many chance words seen as rarely."""
    draw = random.Random(11)
    chance = ["".join(draw.choices("aeioulnrst", k=5)) for _ in range(4_000)]
    common = [f"common{chr(97 + i)}" for i in range(20)]
    rare = ["zworg", "bleph", "fangk", "nuskv", "tribq", "plimj"]

    def text(toxic):
        words = draw.choices(common, k=60) + draw.choices(chance, k=20) + (draw.sample(rare, 4) if toxic else draw.choices(chance, k=4))
        draw.shuffle(words)
        return " ".join(words)

    # Each rare word occurs in about four of the six toxic labelled texts.
    toxic = {i: i < 6 or i >= 350 for i in range(400)}
    taught = spark.createDataFrame([(i, text(t)) for i, t in toxic.items()], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(toxic[i])) for i in range(300)], "doc_id bigint, toxic int")
    found = {r.doc_id: r.score for r in toxicity.score(taught, labels).collect()}
    pairs = [(found[a], found[b]) for a in range(350, 400) for b in range(300, 350)]
    assert sum((a > b) + (a == b) / 2 for a, b in pairs) >= 0.95 * len(pairs)


def test_records(spark, docs, none):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(definition)
    index = records.write(docs, scratch_path(spark, "records"), definition, 2)
    back = records.read(spark, index.orderBy(F.desc("start")), "doc_id", "start", "n_tokens").collect()
    start = 0
    for r in sorted(back, key=lambda r: r.start):
        text = "no id" if r.doc_id is None else TEXTS[r.doc_id] or ""
        ids = np.frombuffer(bytes(r.ids), dtype="<u4").tolist()
        assert r.start == start and ids == [*library.encode(text, add_special_tokens=False).ids, 2] and r.n_tokens == len(ids)
        start += len(ids)
    assert len(back) == len(TEXTS) + 2 and back[0].start > back[-1].start
    assert records.write(none, scratch_path(spark, "records"), definition, 2).count() == 0
    whole = records.frame(records.pack(np.array([1, 70_000])))
    assert records.unpack(records.unframe(whole, "x")).tolist() == [1, 70_000]
    with pytest.raises(ValueError):
        records.unframe(whole[:15] + b"?" + whole[16:], "x")


def test_jaccard(spark, docs, none):
    found = {(r.doc_id, r.n_shingles): r.component_id for r in jaccard.join(docs).collect()}
    assert found[5, 1] == found[6, 1] == 5 and found[0, 0] == 0 and found[1, 0] == 1 and found[2, 0] == 2
    assert found[None, 1] is None and jaccard.join(docs).count() == len(TEXTS) + 2
    assert jaccard.join(none).count() == 0
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id = 6").count() == 0 and kept.filter("doc_id <= 4").count() == 5


def test_keep_first_judges_rows(spark):
    a, b, c, d = ("a b c d e", "f g h i j", "k l m n o", "p q r s t")
    rows = [(1, a, "x"), (2, a, "y"), (2, b, "y"), (3, c, "z"), (3, c, "a"), (None, a, "n"), (None, d, "n"), (None, d, "n"), (4, "", "e"), (4, "", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, _row string")
    kept = jaccard.keep_first(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (None, d), (4, ""), (4, "")], key=str)


def test_dealt_bytes_follow_the_occurrences():
    import pyarrow as pa

    texts = [" ".join(f"w{random.Random(i).randrange(5_000)}" for _ in range(40)) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    sizes = {}
    for bits in (4, 12):
        jaccard.TaskContext, kept = type("One", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": staticmethod(lambda: 0)})())}), jaccard.TaskContext
        try:
            (out,) = jaccard._dealt(4, bits)([batch])
        finally:
            jaccard.TaskContext = kept
        sizes[bits] = sum(len(x) for c in ("at", "counts") for x in out.column(c).to_pylist())
    assert sizes[12] <= 8 * 300 * 37  # a document and a count for each occurrence at most, however many buckets


@pytest.mark.parametrize("trees", [{}, {"tree_sets": 4}, {"tree_sets": 20, "tree_shingles": 900}])
def test_jaccard_near_copies(spark, trees):
    from test_queries import brute_components

    rng, texts = random.Random(9), {}
    words = [f"w{i}" for i in range(400)]
    for base in range(4):
        original = [rng.choice(words) for _ in range(60)]
        for copy in range(25):
            changed = list(original)
            for _ in range(copy % 4):
                changed[rng.randrange(60)] = rng.choice(words)
            texts[base * 100 + copy] = " ".join(changed)
    shared = " ".join(rng.choice(words) for _ in range(30))
    texts |= {1000 + i: shared + " " + " ".join(rng.choice(words) for _ in range(i)) for i in range(12)}
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(df, **trees).collect()}
    assert found == brute_components(texts)


def test_tree_is_exact_with_folded_bits(monkeypatch):
    rng = np.random.default_rng(2)
    base = [rng.integers(0, 2**63, 60).astype(np.uint64) for _ in range(5)]
    sets = [np.unique(np.concatenate([b[rng.random(60) > 0.06], rng.integers(0, 2**63, 2).astype(np.uint64)])) for b in base for _ in range(40)]

    def classes(tree):
        tree.links()
        return [tree.find(i) for i in range(len(sets))]

    want = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if jaccard.linked(sets[i], sets[j], 80):
                a, b = want[i], want[j]
                want = [min(a, b) if x in (a, b) else x for x in want]
    for bits in (16_384, 64):
        monkeypatch.setattr(jaccard, "MOST_BITS", bits)
        assert classes(jaccard.Tree(sets, 80)) == want


def test_decontaminate(spark, docs, none):
    passage = [f"p{i}" for i in range(14)]
    items = spark.createDataFrame(
        [("a", " ".join(passage)), ("b", "short item"), ("c", None), ("d", ""), (None, "un named"), ("a2", " ".join(passage[:10])), ("a", "again here")],
        "item_id string, text string",
    )
    rows = [
        (1, "x " + "; ".join(passage).upper() + " y"), (2, " ".join(passage[:9])), (3, "A short, item! and a short thing"), (4, None),
        (5, " ".join(passage[2:12]) + " " + " ".join(passage[3:13])), (6, "un named"), (7, ""), (8, LONG + " short item"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_hit", F.lit("clash"))
    for lot in (500_000, 5):
        found = {r.doc_id: r for r in decontaminate.matches(df, items, lot_words=lot).collect()}
        assert (found[1].n_hit, found[1].items, found[1].longest) == (14, ["a", "a2"], 14)
        assert found[2].n_hit == 0 and found[2].longest == 0
        assert (found[3].n_hit, found[3].items) == (2, ["b"]) and found[4].n_words == 0
        assert found[5].n_hit == 20 and found[5].items == ["a"] and (found[6].n_hit, found[6].items) == (2, [])
        assert found[8].n_hit == 2
    cleaned = decontaminate.clean(df, items)
    kept = {r.doc_id: r.text for r in cleaned.collect()}
    assert cleaned.columns == df.columns and 1 not in kept and kept[3] == "A ! and a short thing"
    assert kept[4] is None and 5 not in kept and 6 not in kept and kept[8] == LONG + " " and kept[2] == rows[1][1]
    assert decontaminate.matches(none, items).count() == 0
    assert {r.n_hit for r in decontaminate.matches(docs, items.filter("false")).collect()} == {0}

