import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from llm_helpers import documents, prose

from ledgerwalk.llm import toxicity
from ledgerwalk.llm.toxicity import FEATURES, Weights, _char_classes, features, fit_toxicity, held_out, toxicity_report
from pyspark.sql import functions as F

INSULTS = ["grobblex", "vermitch", "snivelor", "drossling"]


def corpus(n=700, seed=1):
    rnd = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = prose(seed * 10_000 + i, rnd.randint(15, 120)).split()
        bad = i % 5 == 0
        if bad:
            for _ in range(rnd.randint(2, 4)):
                words.insert(rnd.randrange(len(words)), rnd.choice(INSULTS) + rnd.choice(["", "", "ing"]))
        rows.append((i, " ".join(words)))
        if i % 10 < 8:
            labels.append((i, 1, int(bad)))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = corpus()
    docs, known = documents(spark, rows), spark.createDataFrame(labels, LABELS)
    return docs, known, fit_toxicity(docs, known)


def test_held_out_accuracy(spark, fitted):
    docs, known, model = fitted
    got = {r["row"]["doc_id"]: r["score"] for r in model.score(docs).collect()}
    assert len(got) == 700
    out = [i for i in got if zlib.crc32(str(i).encode()) % 4 == 2]
    wrong = sum((got[i] >= 0.3) != (i % 5 == 0) for i in out)
    assert len(out) > 120 and wrong <= 0.05 * len(out)
    assert all(0 <= s <= 1 for s in got.values())


def test_labels_of_held_out_rows_are_not_learnt(spark, fitted):
    docs, known, model = fitted
    flipped = known.withColumn("toxic", F.when(held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = fit_toxicity(docs, flipped)
    columns = ("row.doc_id", "score")
    assert sorted(map(tuple, again.score(docs).select(*columns).collect())) == sorted(map(tuple, model.score(docs).select(*columns).collect()))


def test_report_columns_nulls_empties_repeats_and_long_texts(spark, fitted):
    _, known, model = fitted
    long = prose(77, 30_000)
    rows = [(1, None), (2, ""), (3, "!!!"), (3, "!!!"), (None, prose(5, 60)), (4, long), (5, "grobblex vermitch snivelor you " + prose(6, 20))]
    got = [(r["row"]["doc_id"], r["row"]["row"], r["score"]) for r in model.score(documents(spark, rows, clashing=True)).collect()]
    assert len(got) == 7 and all(x == "clash" for _, x, _ in got)
    score = {i: s for i, _, s in got}
    assert score[1] == score[2] < 0.3 and score[4] < 0.3 < score[5]


def test_without_both_labels_the_score_is_constant(spark):
    docs = documents(spark, [(i, "some words") for i in range(6)] + [(None, "x")])
    for labels, want in (([], 0.0), ([(i, 1, 0) for i in range(6)], 0.0), ([(i, 1, None) for i in range(6)], 0.0),
                         ([(i, 1, 1) for i in range(6)], 1.0), ([(99, 1, 1)], 0.0)):
        got = toxicity_report(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert len(got) == 7 and {r["score"] for r in got} == {want} and {r["predicted"] for r in got} == {int(want)}
    assert [r["held_out"] for r in got if r["doc_id"] is not None] == [zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in got if r["doc_id"] is not None]
    assert toxicity_report(documents(spark, []), spark.createDataFrame([], LABELS)).collect() == []


def test_features():
    weights, kinds = Weights({"idiot": 3.0, "lowe*": 2.0}), _char_classes()

    def f(text):
        return dict(zip(FEATURES, features(text, weights, kinds)))

    assert not any(features("", weights, kinds))
    plain, bad = f("a fine day for all of them"), f("YOU are an Idiot and loweness")
    assert plain["hit_rate"] == 0 and bad["log_hits"] == pytest.approx(np.log1p(2)) and bad["most_weight"] == 3.0
    assert bad["near_second"] == 1.0 and bad["capital_rate"] > plain["capital_rate"] and bad["shouted_rate"] > 0
    assert f("such an 1d10t and i.d.i.o.t here")["log_hidden"] > 0 and f("idiots")["hit_rate"] == 0
    assert f("word " * 500 + "idiot " * 5)["densest"] == 5 and f("sooo good!!!")["stretched_rate"] > 0


SECOND = set("""you your yours yourself yourselves u ur du dich dir dein deine deinen deiner euch euer eure tu te toi ton ta tes
vous votre vos tú ti tus usted ustedes vosotros""".split())
LEET = dict(zip("013457@$!|", "oieastasil"))
SIGNS = "0123456789@$!*._+|-"


def plain_features(text, lexicon):
    """All seventeen features by their definitions: characters and words one by one."""
    def weight(word):
        if word in SECOND:
            return -1.0
        return max([lexicon.get(word, 0.0)] + [lexicon.get(word[:n] + "*", 0.0) for n in range(3, 9) if n < len(word)])

    def letter(c):
        return c.isalpha()

    data = text.encode("utf-8", "surrogatepass")
    if not data:
        return dict.fromkeys(FEATURES, 0.0)
    low, words, word = text.lower(), [], ""
    for c in low + " ":
        if letter(c):
            word += c
        elif word:
            words.append(word)
            word = ""
    n, w = max(1, len(words)), [weight(x) for x in words]
    hits = [i for i, x in enumerate(w) if x > 0]
    second = [i for i, x in enumerate(w) if x < 0]

    # hidden words: letters parted by one to three signs, or led by one to three signs that stand for letters
    def parts(at):
        """Letters and signs from ``at`` on: longest letters, then 1-3 signs and letters, over and over."""
        out, i, again = "", at, 0
        while i < len(low) and letter(low[i]):
            out, i = out + low[i], i + 1
        while True:
            for k in (3, 2, 1):
                signs = low[i:i + k]
                if len(signs) == k and all(c in SIGNS for c in signs) and i + k < len(low) and letter(low[i + k]):
                    out, i, again = out + signs, i + k, again + 1
                    while i < len(low) and letter(low[i]):
                        out, i = out + low[i], i + 1
                    break
            else:
                return out, i, again
    hidden, i = 0, 0
    while i < len(low):
        found = None
        if letter(low[i]) and not (i and letter(low[i - 1])):
            out, end, again = parts(i)
            found = (out, end) if again else None
        if found is None and not (i and (letter(low[i - 1]) or low[i - 1].isalnum())):
            for k in (3, 2, 1):
                lead = low[i:i + k]
                if len(lead) == k and all(c in LEET for c in lead) and i + k < len(low) and letter(low[i + k]):
                    out, end, _ = parts(i + k)
                    found = (lead + out, end)
                    break
        if found is None:
            i += 1
            continue
        mixed, i = found
        read = "".join(c for c in "".join(LEET.get(c, c) for c in mixed) if letter(c))
        bare = "".join(c for c in mixed if letter(c))
        led = not letter(mixed[0]) and "".join(c for c in mixed.lstrip("".join(c for c in mixed if not letter(c)))) == bare
        hidden += weight(read) > 0 or (not led and weight(bare) > 0)

    kinds = ["L" if 97 <= b <= 122 or b >= 128 else "U" if 65 <= b <= 90 else "D" if 48 <= b <= 57
             else "!" if b == 33 else "P" if 33 < b < 127 else " " for b in data]
    is_letter = [k in "LU" for k in kinds]
    is_sign = [k in "D!P" for k in kinds]
    obfuscated = sum(is_letter[i] and all(is_sign[i + 1:i + 1 + k]) and len(kinds) > i + 1 + k and is_letter[i + 1 + k]
                     for i in range(len(kinds)) for k in (1, 2, 3) if i + 1 + k < len(kinds))
    ascii_runs = "".join(c if c.isalnum() or c == "_" else " " for c in text).split()
    stretched = i = 0
    while i + 2 < len(text):
        if text[i] == text[i + 1] == text[i + 2] and text[i].isascii() and text[i].isalpha():
            stretched, i = stretched + 1, i + 3
        else:
            i += 1
    upper = kinds.count("U")
    return {
        "log_words": np.log1p(len(words)), "hit_rate": 100 * len(hits) / n, "log_hits": np.log1p(len(hits)),
        "weight_rate": sum(w[i] for i in hits) / n, "most_weight": max((w[i] for i in hits), default=0.0),
        "log_distinct": np.log1p(len({words[i] for i in hits})),
        "densest": max((sum(i <= j < i + 50 for j in hits) for i in hits), default=0),
        "hidden_rate": 100 * hidden / n, "log_hidden": np.log1p(hidden),
        "near_second": sum(any(abs(i - j) <= 5 for j in second) for i in hits) / len(hits) if hits else 0.0,
        "second_rate": len(second) / n, "capital_rate": upper / max(1, sum(is_letter)),
        "shouted_rate": sum(len(x) >= 3 and all("A" <= c <= "Z" for c in x) for x in ascii_runs) / n,
        "exclamation_rate": kinds.count("!") / n, "punctuation_rate": (kinds.count("P") + kinds.count("!")) / len(data),
        "obfuscation_rate": obfuscated / n, "stretched_rate": stretched / n}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["idiot", "IDIOT", "i", "d1ot", "id", "iot", "lowest", "you", "DU", "é", "É", "x", "1", "5", "$", "!", "@", ".",
                                 "-", "_", " ", " ", " ", "\n", "aaa", "ooO", "word", "the", "i.d.i.o.t", "1d10t", "|", "ß", "日"]), max_size=30).map("".join))
def test_all_features_equal_their_definitions(text):
    lexicon = {"idiot": 3.0, "lowe*": 2.0, "id": 0.5, "iot": 1.25}
    got = dict(zip(FEATURES, features(text, Weights(lexicon), _char_classes())))
    assert got == pytest.approx(plain_features(text, lexicon))


def test_repeated_ids_keep_the_sample_bounded(spark, monkeypatch):
    """An id that holds a third of all rows is one training row."""
    rows, labels = corpus(300)
    many = rows + [(rows[0][0], f"{rows[0][1]} {k}") for k in range(600)]
    stored = {}
    plain = toxicity.store
    monkeypatch.setattr(toxicity, "store", lambda df, name: stored.setdefault(name, plain(df, name)))
    model = fit_toxicity(documents(spark, many), spark.createDataFrame(labels, LABELS), sample_rows=100)
    assert stored["labelled"].count() == 100 and model.trees is not None


def test_calibration_of_equal_margins_is_the_same(spark):
    """Grouped to weighted rows, isotonic regression gives the same steps."""
    from pyspark.ml.regression import IsotonicRegression

    rnd = random.Random(8)
    df = spark.createDataFrame([(float(rnd.randint(0, 9)) / 9, float(rnd.random() < 0.5)) for _ in range(400)], "raw double, label double")
    grouped = df.groupBy("raw").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("rows"))
    a = IsotonicRegression(featuresCol="raw", labelCol="label").fit(df)
    b = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="rows").fit(grouped)
    at = np.linspace(0, 1, 40)
    assert np.allclose([a.predict(x) for x in at], [b.predict(x) for x in at])


@pytest.mark.parametrize("text, runs", [
    ("such an 1d10t here", 1), ("i.d.i.o.t", 4), ("such an i$$iot here", 1), ("an id!!!iot", 1), ("id--iot", 1),
    ("1diot", 0), ("an !diot", 0), ("an i-d10t.", 2)])
def test_each_obfuscated_spelling_alone(text, runs):
    weights = Weights({"idiot": 3.0, "issiot": 2.0})
    got = dict(zip(FEATURES, features(text, weights, _char_classes())))
    words = len([w for w in "".join(c if c.isalpha() else " " for c in text).split()])
    assert got["hit_rate"] == 0 and got["log_hidden"] == pytest.approx(np.log1p(1)) and got["hidden_rate"] > 0
    assert got["obfuscation_rate"] == pytest.approx(runs / words)


def test_plain_texts_hide_nothing():
    weights, kinds = Weights({"idiot": 3.0}), _char_classes()
    for text in ("", "a", "5", "a5", "5a", "a 5 b", "an idiot!", "$5 idiot", "5idiot", "id....iot", "x" * 50_000 + " 1x"):
        assert dict(zip(FEATURES, features(text, weights, kinds)))["log_hidden"] == 0
