"""Language, toxicity, word model and similarity join on small tables."""

import collections
import math
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from arealytics.llm import language, ngram_join, pitman_yor, toxicity
from arealytics.llm.common import lower_words, remainder
from arealytics.llm.components import components

WORDS = {
    "aa": ["the", "and", "with", "house", "green", "water"],
    "bb": ["der", "und", "mit", "haus", "grün", "wasser"],
    "cc": ["le", "et", "avec", "maison", "verte", "eau"],
}


def prose(draw, lang, count):
    return " ".join(draw.choices(WORDS[lang], k=count))


DOCS = "doc_id long, text string, lang string, score double, row int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, l, 0.5, 1) for i, t, l in rows], DOCS)


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(2)
    rows = [(i, prose(draw, l, draw.randint(4, 60)), l) for i, l in enumerate(["aa", "bb", "cc"] * 60)]
    rows += [(500, None, None), (501, "", None), (502, "12 !?", "aa"), (None, "the and", None)]
    rows += [(503, prose(draw, "bb", 40) + " " + prose(draw, "cc", 20), None), (504, "the " * 20_000, None)]
    return docs_of(spark, rows)


def test_language_of_held_out_texts(corpus):
    model = language.learn(corpus, remainder("doc_id", 5) != 0)
    assert model.languages == ["aa", "bb", "cc"]
    found = language.identify(corpus, model).collect()
    assert len(found) == 186
    truth = {r.doc_id: r.lang for r in corpus.collect() if r.lang and r.doc_id < 500}
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == l for i, l in truth.items())
    for i in (500, 501, 502):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    mixed = by_id[503]
    assert mixed.lang_pred == "bb" and set(mixed.shares) == {"bb", "cc"}
    assert abs(mixed.shares["bb"] - 2 / 3) < 0.12
    assert by_id[504].lang_pred == "aa" and all(0 <= r.score <= 1 for r in found)


def test_language_stage_keeps_columns(corpus):
    model = language.learn(corpus, F.lit(True))
    kept = language.in_known_language(corpus, model)
    assert kept.schema == corpus.schema
    assert {r.doc_id for r in corpus.collect()} - {r.doc_id for r in kept.collect()} == {500, 501, 502}
    assert language.in_known_language(corpus.where("false"), model).count() == 0


def test_language_without_labels(corpus):
    assert language.learn(corpus, F.lit(False)) is None
    assert {(r.lang_pred, r.score) for r in language.identify(corpus, None).collect()} == {("und", 0.0)}


def test_mixture_fit_reaches_the_likelihood_of_brute_force():
    random_ = np.random.default_rng(4)
    model = random_.random((30, 2)).astype(np.float32)
    counts = random_.integers(1, 9, 30).astype(float)
    share, fit, missing = language._fit(model, counts, np.zeros(30, int), np.ones((1, 2)), 40)
    grid = max((np.log(model @ [p, 1 - p]) @ counts, p) for p in np.linspace(0.001, 0.999, 999))
    assert fit[0] <= grid[0] + 1e-6 and grid[0] - fit[0] < 0.5
    assert share.sum() == pytest.approx(1)
    assert grid[0] <= fit[0] + missing[0]


def test_toxicity(spark):
    draw = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        bad = i % 5 == 0
        words = draw.choices(WORDS["aa"] + WORDS["bb"], k=draw.randint(5, 80))
        if bad:
            words.insert(draw.randrange(len(words)), ["vilex", "grossy"][i // 10 % 2] + draw.choice(",.!"))
        rows.append((i, " ".join(words), None))
        if i % 2 == 0:
            labels += [(i, int(bad), "t")] * draw.randint(1, 2)
    rows += [(2000, None, None), (2001, "", None), (None, "vilex", None), (2002, "VILEX " * 20_000, None)]
    docs = docs_of(spark, rows)
    table = spark.createDataFrame(labels + [(None, 1, ""), (3, None, "")], "doc_id long, toxic int, text string")
    model = toxicity.learn(docs, table, lambda key: remainder(key, 3) != 1)
    found = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert len(found) == len(rows)
    wrong = [i for i in range(900) if (found[i] >= 0.7) != (i % 5 == 0)]
    assert not wrong
    assert found[2000] == found[2001] < 0.7 <= found[2002]
    again = toxicity.learn(docs.repartition(3), table, lambda key: remainder(key, 3) != 1)
    assert np.array_equal(again.features, model.features)
    clean = toxicity.without_toxic(docs, model)
    assert clean.schema == docs.schema
    assert {r.doc_id for r in clean.collect()} == {i for i, s in found.items() if s < 0.7}
    nothing = toxicity.learn(docs, table.where("false"), lambda key: F.lit(True))
    assert all(r.score < 1e-12 for r in toxicity.score(docs, nothing).collect())
    assert toxicity.score(docs.where("false"), model).count() == 0


def test_nnpu_recovers_the_prior_corrected_rule():
    random_ = np.random.default_rng(1)
    toxic = random_.random(4000) < 0.2
    told = toxic & (random_.random(4000) < 0.95)
    positive = toxic & (random_.random(4000) < 0.3)
    rows = np.flatnonzero(told)
    weights, bias = toxicity.fit_nnpu(
        rows, np.zeros(len(rows), int), positive.astype(float), np.ones(4000), 1, 0.2
    )
    assert bias < 0 < weights[0] + bias


def brute_links(rows, n=5, similarity=0.8):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        if i is not None and words:
            sets.setdefault(i, {tuple(words[j : j + n]) for j in range(max(1, len(words) - n + 1))})
    links = collections.Counter()
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if len(x & y) >= similarity * len(x | y) - 1e-9:
                links[ids[a]] += 1
                links[ids[b]] += 1
                p, q = sorted((root(ids[a]), root(ids[b])))
                parent[q] = p
    return links, {i: root(i) for i in parent}


def near_copies(draw):
    base = [f"w{draw.randrange(400)}" for _ in range(120)]
    rows = [(0, " ".join(base))]
    for i in range(1, 60):
        words = list(base)
        for _ in range(draw.randint(0, 4)):
            words[draw.randrange(len(words))] = f"x{draw.randrange(9)}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"w{draw.randrange(400)}" for _ in range(40))) for i in range(40)]
    rows += [(200, "Same short text"), (201, "same short TEXT"), (202, "same short"), (203, ""), (204, None), (205, " ")]
    rows += [(300, rows[0][1]), (301, rows[0][1]), (302, "z " * 20_000), (303, "z " * 30_000)]
    return rows


@pytest.mark.parametrize("block", [4, 256])
def test_links_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(random.Random(6))
    docs = spark.createDataFrame([(i, t, 3, "c") for i, t in rows], "doc_id long, text string, band int, class_id string")
    found = {r.doc_id: r for r in ngram_join.similar_documents(docs).collect()}
    links, roots = brute_links(rows)
    assert len(found) == len(rows)
    assert {i: r.n_links for i, r in found.items()} == {i: links[i] for i, _ in rows}
    assert {i: r.class_id for i, r in found.items()} == roots
    assert found[301].copy_of == 0
    left = ngram_join.one_of_each(docs)
    assert left.schema == docs.schema
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, r in roots.items() if i == r)


def test_repeated_and_missing_ids(spark):
    long = " ".join(map(str, range(30)))
    docs = spark.createDataFrame(
        [(1, long), (1, long), (2, long + " x"), (None, long), (2, "other words here")], "doc_id long, text string"
    )
    found = [(r.doc_id, r.class_id, r.n_links) for r in ngram_join.similar_documents(docs).collect()]
    assert sorted(found, key=str) == sorted(
        [(1, 1, 1), (1, 1, 1), (2, 1, 1), (2, 1, 1), (None, None, 0)], key=str
    )
    kept = [r.doc_id for r in ngram_join.one_of_each(docs).collect()]
    # the second text of id 2 has no copy
    assert sorted(kept, key=str) == [1, 2, None]
    assert ngram_join.similar_documents(docs.where("false")).count() == 0


def test_texts_of_one_id_are_judged_each_for_itself(spark):
    long, other = " ".join(map(str, range(30))), " ".join(f"w{i}" for i in range(30))
    rows = [(2, long + " x", 1, "p"), (2, other, 2, "q"), (2, other, 2, "q"), (1, long, 3, "r"), (3, other + " y", 4, "s"), (4, "", 5, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _ngram_row int, row string")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(1, long, 3, "r"), (2, other, 2, "q"), (4, "", 5, "t")]
    again = ngram_join.one_of_each(docs.repartition(5))
    assert sorted(kept.collect()) == sorted(again.collect())
    unique = docs.where("doc_id <> 2")
    assert sorted(r.doc_id for r in ngram_join.one_of_each(unique).collect()) == [1, 3, 4]


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.8, 0.95):
        bands, rows = ngram_join.bands_and_rows(similarity, 0.99)
        assert 1 - (1 - similarity**rows) ** bands >= 0.99
        assert bands * rows <= ngram_join.MAX_HASHES


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (95, 90), (7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {90: 90, 95: 90, 100: 90}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def base_scores(rows, trains):
    tokens = {i: (t or "").encode().lower().split() + [None] for i, t in rows}
    counts = collections.Counter(w for i in tokens if trains(i) for w in tokens[i])
    total, kinds = sum(counts.values()), len(counts)
    return tokens, counts, {
        i: sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in t)
        for i, t in tokens.items()
    }


def test_word_model(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "CHUNK_TEXTS", 37)
    monkeypatch.setattr(pitman_yor, "FREQUENT", 12)  # so that both kinds of context occur
    draw = random.Random(9)
    rows = []
    for i in range(250):
        words = ["the"]
        for _ in range(draw.randint(0, 60)):
            follow = {"the": ["house", "water", "green"], "and": ["the"], "of": ["the", "water"]}
            words.append(draw.choice(follow.get(words[-1], ["and", "of", f"rare{draw.randrange(300)}"])))
        rows.append((i, " ".join(words)))
    rows += [(300, None), (301, ""), (302, "THE house"), (303, "unseen words only"), (304, "the " * 20_000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    scored, model = pitman_yor.score_corpus(docs, F.col("doc_id") % 5 != 1)
    found = {r.doc_id: r for r in scored.collect()}
    tokens, counts, base = base_scores(rows, lambda i: i % 5 != 1)
    assert len(found) == len(rows) and model.tokens == sum(counts.values()) and model.words == len(counts)
    assert 1 < len(model.frequent.words) <= 13
    # every word that another follows has a restaurant, and so has the beginning
    contexts = {w for i, t in tokens.items() if i % 5 != 1 for w in t if w is not None}
    assert model.contexts == len(contexts) + 1
    for i, t in tokens.items():
        assert found[i].n_tokens == len(t)
        assert found[i].n_known == sum(w in counts for w in t)
        assert found[i].base_score == pytest.approx(base[i], abs=1e-6)
    held = [i for i in range(250) if i % 5 == 1]
    assert sum(found[i].score for i in held) > sum(found[i].base_score for i in held)
    again, _ = pitman_yor.score_corpus(docs, F.col("doc_id") % 5 != 1)
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in found.items()}


@pytest.mark.parametrize("frequent", [4, 50_000])
def test_word_model_probabilities_add_up(spark, monkeypatch, frequent):
    monkeypatch.setattr(pitman_yor, "FREQUENT", frequent)
    draw = random.Random(4)
    rows = [(i, " ".join(draw.choices("a b c d e".split(), [9, 3, 3, 1, 1], k=8))) for i in range(40)]
    training = spark.createDataFrame(rows, "doc_id long, text string")
    model, seating = pitman_yor.fit(training)
    assert model.contexts == 6
    # directly: all words after one context and the unknown one add up to one
    buckets = {r["bucket"]: pitman_yor.Bucket(r.asDict(), model.frequent) for r in seating.dishes.collect()}
    whole = {}
    for row in seating.contexts.collect():
        names = np.frombuffer(row["names"], np.uint64)
        totals = np.frombuffer(row["totals"], np.uint32).reshape(-1, len(names))
        for i, name in enumerate(names):
            whole[int(name)] = np.frombuffer(row["customers"], np.uint32)[i], totals[:, i]
    empty = dict.fromkeys(("words", "sizes", "contexts", "others", "counts"), b"")
    scorers = {n: pitman_yor._Scorer(b, model, 1) for n, b in buckets.items()}
    words = np.unique(np.concatenate([b.words for b in buckets.values()]))
    unknown = np.uint64(7 << 56 | 12345)
    for context in np.concatenate([words, [pitman_yor.BEGIN, unknown]]):
        place = int(model.frequent.find(np.array([context]))[0])
        total = 0.0
        for word in np.append(words, unknown):
            number = int(pitman_yor._deal(
                np.array([word]), model.frequent.find(np.array([word])),
                pitman_yor._class(np.array([context])), model.buckets,
            )[0])
            if number not in scorers:
                bare = pitman_yor.Bucket({"bucket": number, **empty}, model.frequent)
                scorers[number] = pitman_yor._Scorer(bare, model, 1)
            logs, _, _, asked, above = scorers[number].score(
                np.array([word]), np.array([1]),
                np.array([place if place >= 0 else pitman_yor.OTHER], np.uint16),
                np.array([] if place >= 0 else [context], np.uint64),
            )
            if asked[0]:
                customers, totals = whole.get(int(context), (0, np.zeros(3)))
                shares = [
                    (1 + model.discounts[2] * float(totals[s - 1])) / (1 + float(customers)) for s in (2, 3)
                ]
                total += np.mean([share * a[0] for share, a in zip(shares, above)])
            else:
                total += 10 ** float(logs[0])
        assert total == pytest.approx(1.0, abs=1e-9)


def direct_scores(texts, wanted, discounts, sweeps, burn_in):
    """Customers are taken out and seated again one by one."""
    draw = random.Random(5)
    ending = lambda w: "^" if w == "^" else int(pitman_yor._class(np.array([hashed(w)]))[0])

    def hashed(word):
        places = pitman_yor._Places()
        places[word.encode()]
        return places.hashes()[2]

    class_of = {w: ending(w) for t in texts + wanted for w in ["^", *t.split()]}
    kinds = len({w for t in texts for w in [*t.split(), "$"]})
    seats = collections.defaultdict(lambda: collections.defaultdict(list))  # restaurant -> dish -> tables

    def above(place):
        return {2: lambda: (1, class_of[place[1]]), 1: lambda: (0, None)}[place[0]]()

    def chance(place, word):
        if place is None:
            return 1 / (kinds + 1)
        tables, d = seats[place], discounts[place[0]]
        own = tables.get(word, [])
        size, count = sum(map(sum, tables.values())), sum(map(len, tables.values()))
        up = chance(above(place) if place[0] else None, word)
        return (sum(own) - d * len(own) + (1 + d * count) * up) / (1 + size)

    def add(place, word):
        tables, d = seats[place][word], discounts[place[0]]
        up = chance(above(place) if place[0] else None, word)
        count = sum(map(len, seats[place].values()))
        weights = [n - d for n in tables] + [(1 + d * count) * up]
        at = draw.choices(range(len(weights)), weights)[0]
        if at < len(tables):
            tables[at] += 1
        else:
            tables.append(1)
            if place[0]:
                add(above(place), word)

    def remove(place, word):
        tables = seats[place][word]
        at = draw.choices(range(len(tables)), tables)[0]
        tables[at] -= 1
        if not tables[at]:
            tables.pop(at)
            if place[0]:
                remove(above(place), word)

    customers = [((2, u), w) for t in texts for u, w in zip(["^", *t.split()], [*t.split(), "$"])]
    for place, word in customers:
        add(place, word)
    sums, samples = collections.Counter(), 0
    pairs = {((2, u), w) for t in wanted for u, w in zip(["^", *t.split()], [*t.split(), "$"])}
    for sweep in range(sweeps):
        for place, word in customers:
            remove(place, word)
            add(place, word)
        if sweep >= burn_in:
            samples += 1
            for place, word in pairs:
                sums[place, word] += chance(place, word)
    return [
        sum(math.log10(sums[(2, u), w] / samples) for u, w in zip(["^", *t.split()], [*t.split(), "$"]))
        for t in wanted
    ]


@pytest.mark.parametrize("frequent", [6, 50_000])
def test_word_model_follows_a_direct_sampler(spark, monkeypatch, frequent):
    monkeypatch.setattr(pitman_yor, "FREQUENT", frequent)
    draw = random.Random(8)
    follow = {w: draw.sample("a b c d e f g h i j k l".split(), 3) for w in "a b c d e f g h i j k l".split()}
    texts = []
    for _ in range(30):
        words = [draw.choice("abc")]
        while len(words) < 8:
            words.append(draw.choice(follow[words[-1]]) if draw.random() < 0.8 else draw.choice("abcdefghijkl"))
        texts.append(" ".join(words))
    wanted = [*texts[:6], "a a b", "l k j i", "zz a", "c"]
    model, seating = pitman_yor.fit(
        spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), sweeps=30
    )
    docs = spark.createDataFrame(list(enumerate(wanted)), "doc_id long, text string")
    found = {r.doc_id: r for r in pitman_yor.score_texts(docs, model, seating, burn_in=5, rounds=1).collect()}
    expected = direct_scores(texts, wanted, model.discounts, 150, 20)
    for i, score in enumerate(expected):
        assert found[i].score / found[i].n_tokens == pytest.approx(score / found[i].n_tokens, abs=0.03)


def test_word_model_holds_the_answers_of_one_part(spark, monkeypatch):
    draw = random.Random(6)
    rows = [(i, " ".join(draw.choices("a b c d e f".split(), k=8))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, seating = pitman_yor.fit(docs)
    store, answers, held = pitman_yor._store, [], []

    def watched(df):
        stored = store(df)
        if "above" in df.columns:
            answers.append([Path(f.removeprefix("file:")) for f in stored.inputFiles()])
            held.append(sum(any(f.exists() for f in files) for files in answers))
        return stored

    monkeypatch.setattr(pitman_yor, "_store", watched)
    whole, parts = (
        {r.doc_id: r for r in pitman_yor.score_texts(docs, model, seating, rounds=n).collect()} for n in (1, 3)
    )
    assert held == [1, 1, 1, 1] and all(answers)
    assert not any(f.exists() for files in answers for f in files)
    assert whole.keys() == parts.keys() == {i for i, _ in rows}
    for i, row in whole.items():
        assert parts[i] == pytest.approx(row, abs=1e-9)


def test_word_model_redraws_every_context_given_its_parent(spark, monkeypatch):
    monkeypatch.setattr(pitman_yor, "FREQUENT", 4)
    draw = random.Random(11)
    words = "a b c d e f g h".split()
    rows = [(i, " ".join(draw.choices(words, [9, 3, 3, 2, 2, 1, 1, 1], k=12))) for i in range(60)]
    model, seating = pitman_yor.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    changed = 0
    for row in seating.dishes.collect():
        stored = pitman_yor.Bucket(row.asDict(), model.frequent).seats

        def drawn(at):
            bucket = pitman_yor.Bucket(row.asDict(), model.frequent)
            bucket.seats = [seats[:at] for seats in stored]
            bucket.sweep(model, at - 1)
            whole = bucket.drawn[1][at - 1] if len(bucket.names) else None
            bucket.sweep(model, at, whole)
            return bucket

        # each seating is drawn from the one before, its parents' totals and its contexts' totals
        for at in (1, 2):
            bucket = drawn(at)
            found = bucket.tables, bucket.parent_tables, bucket.root_tables
            assert [pitman_yor._planes(x) for x in found] == [bytes(seats[at]) for seats in stored]
        before, totals = drawn(2), model.record[2].tables[1]
        model.record[2].tables[1] = totals * 1000
        after = drawn(2)
        model.record[2].tables[1] = totals
        changed += (before.tables != after.tables)[before.other].sum()
    assert changed


def test_word_model_draws_nothing_while_scoring(spark, monkeypatch):
    draw = random.Random(7)
    rows = [(i, " ".join(draw.choices("a b c d e f".split(), k=8))) for i in range(60)]
    model, seating = pitman_yor.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    assert pitman_yor._log_stirling(model.discounts[0]) is pitman_yor._log_stirling(model.discounts[0])

    def never(*_):
        raise AssertionError("a sweep is drawn again")

    monkeypatch.setattr(pitman_yor, "draw_tables", never)
    found = [pitman_yor.Bucket(r.asDict(), model.frequent) for r in seating.dishes.collect()]
    assert found
    last = model.record[-1]
    scorers = [pitman_yor._Scorer(bucket, model, 0) for bucket in found]
    assert all([s.at for s in scorer.samples] == [1, 2, 3] for scorer in scorers)
    # the stored seatings are those that the recorded totals were added up from
    assert sum(bucket.parent_tables.sum() for bucket in found) == last.tables[1].sum()
    assert sum(bucket.totals()[3] for bucket in found).tolist() == last.tables[2].tolist()


def test_words_of_a_chunk():
    draw = random.Random(3)
    texts = [None, "", " ", "\t A\x0bb\x0c\n", "\x1cÉ é\x85ß\u3000z \x00"]
    texts += ["".join(draw.choices("aBé \n\t\x1d\u3000", k=draw.randint(0, 30))) for _ in range(600)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["id", "text"])
    (chunk,) = pitman_yor._chunks([batch], 1)
    at = 0
    for text, size in zip(texts, chunk.sizes):
        places = pitman_yor._Places()
        tokens = [places[w] for w in lower_words(text)] + [0]
        assert places.hashes()[tokens].tolist() == chunk.words[chunk.tokens[at : at + size]].tolist()
        at += size
    assert at == len(chunk.tokens) and chunk.ids == list(range(len(texts)))


@pytest.mark.parametrize("values", [[[1, 2], [3, 255]], [[256, 0]], [[1, 70_000], [2, 3]], [[], []]])
def test_planes(values):
    values = np.array(values, np.int64)
    assert pitman_yor._from_planes(pitman_yor._planes(values), *values.shape).tolist() == values.tolist()


def test_word_model_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    scored, model = pitman_yor.score_corpus(docs, F.lit(False))
    found = {r.doc_id: (r.n_tokens, r.n_known, r.score) for r in scored.collect()}
    assert found == {1: (3, 0, 0.0), 2: (1, 0, 0.0)} and model.tokens == 0
    none, _ = pitman_yor.score_corpus(docs.where("false"), F.lit(True))
    assert none.count() == 0


def test_tables_follow_the_exact_conditional():
    random_ = np.random.default_rng(3)
    customers = np.full(40_000, 3)
    drawn = pitman_yor.draw_tables(customers, np.full(40_000, 10), np.full(40_000, 0.2), 0.5, random_)
    stirling = np.exp(pitman_yor._log_stirling(0.5)[3, 1:4])
    weight = stirling * np.cumprod(1.0 + 0.5 * (10 + np.arange(3))) * 0.2 ** np.arange(1, 4)
    expected = weight / weight.sum()
    assert np.abs(np.bincount(drawn, minlength=4)[1:] / 40_000 - expected).max() < 0.01
    many = pitman_yor.draw_tables(np.array([10**9]), np.array([5]), np.array([0.1]), 0.5, random_)
    assert 1 <= many[0] <= 10**9
