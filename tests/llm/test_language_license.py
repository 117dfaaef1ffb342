import math

import numpy as np
import pytest
from helpers import SF, crc, messy, none_of, rows_by

from envflow.llm import catalog, language_id, license_scan
from envflow.llm.license_templates import TEMPLATES


@pytest.fixture(scope="module")
def predicted(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    return docs, rows_by(catalog.op8_language_id(spark, SF))


def test_op8_held_out_accuracy(predicted):
    docs, got = predicted
    assert len(got) == len(docs)
    assert all(r.held_out == (crc(i, 4) == 2) for i, r in got.items())
    held = [i for i, r in got.items() if r.held_out]
    right = [i for i in held if got[i].lang_pred == docs[i].lang]
    assert len(right) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())
    # calibrated: the mean score is near the accuracy
    assert abs(np.mean([got[i].score for i in held]) - len(right) / len(held)) < 0.1


def test_labels_and_ids_are_not_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = language_id.train(docs)
    text = docs.first().text
    rows = spark.createDataFrame([(1, text, "xx"), (2, text, None), (999, text, "en")], "doc_id long, text string, lang string")
    got = {(r.lang_pred, r.score) for r in language_id.predict(rows, model).collect()}
    assert len(got) == 1


def test_penalties_make_weights_sparse(spark):
    model = language_id.train(spark.read.parquet(f"{SF}/documents.parquet"))
    assert (model.weights == 0).mean() > 0.3


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(0)
    logits = rng.normal(size=(500, 3)) * 8
    labels = np.array([rng.choice(3, p=p) for p in language_id.softmax(logits / 4)])
    assert 2.5 < language_id.fit_temperature(logits, labels) < 6
    assert language_id.fit_temperature(np.empty((0, 3)), np.empty(0, dtype=int)) == 1.0


def test_features_do_not_depend_on_the_batch():
    texts = ["Été à Paris, 12!", "", "x", "日本語 テキスト", "İstanbul  --  ok", "a" * 3000]
    together = language_id.features(texts)
    for i, t in enumerate(texts):
        row, f, n = language_id.features([t])
        assert (together[1][together[0] == i] == f).all() and (together[2][together[0] == i] == n).all()


def test_messy_rows(spark):
    docs = messy(spark)
    got = language_id.identify(docs).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (3, 4, 5, 9))
    assert by[1].lang_pred != "und" and not by[None].held_out
    assert language_id.identify(none_of(docs)).count() == 0
    unlabelled = language_id.identify(docs.drop("lang").selectExpr("*", "cast(null as string) lang")).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    left = language_id.reject_unknown(docs, 0.3)
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 1, 2, 6, 7, 8]


def test_op9_finds_the_plain_lines(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got: dict = {}
    for r in catalog.op9_license_scans(spark, SF).collect():
        got.setdefault((r.doc_id, r.license), []).append(docs[r.doc_id][r.start : r.end])
    for name, line in TEMPLATES.items():
        if name == "MIT-licensed":
            continue
        for i, t in docs.items():
            if t.count(line):
                assert len(got.get((i, name), [])) == t.count(line), (i, name)


def scan(texts):
    return license_scan.scan_texts(texts, license_scan.Index.of(TEMPLATES), license_scan.COVERAGE)


def test_every_template_is_found_in_noise_and_with_changes():
    for name, t in TEMPLATES.items():
        text = f"Ünrelated wörds before. {t} And words after it."
        (found,) = [x for x in scan([text])[0] if x[0] == name]
        assert found[3] == 1.0
        assert text[found[1] : found[2]].split()[0].strip('"') == t.split()[0].strip('"')
        words = t.split()
        if len(words) >= 14:  # a replaced, a dropped and an added word; other case and line breaks
            words[5] = "WHATEVER"
            del words[8]
            words.insert(11, "really")
            (found,) = [x for x in scan(["x\n" + "\n* ".join(words).upper()])[0] if x[0] == name]
            assert 0.85 <= found[3] < 1


def test_the_better_of_two_overlapping_templates_stays():
    found = scan(["This work is licensed under the GNU General Public License, version 2."])[0]
    assert [x[0] for x in found] == ["GPL-2.0-short"]
    assert scan(["All rights are reserved here by the licensed software.", "", "x" * 100_000]) == [[], [], []]


def test_winnowing_guarantee():
    rng = np.random.default_rng(2)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    for _ in range(50):
        shared = letters[rng.integers(0, 26, license_scan.K + license_scan.WINDOW - 1)].tobytes()
        a, b = (letters[rng.integers(0, 26, 40)].tobytes() + shared + letters[rng.integers(0, 26, 40)].tobytes() for _ in range(2))
        assert set(license_scan.selected(a)[1].tolist()) & set(license_scan.selected(b)[1].tolist())


def test_license_messy_rows(spark):
    docs = messy(spark)
    assert license_scan.scan_licenses(docs).count() == 0
    line = TEMPLATES["MIT-short"]
    many = spark.createDataFrame([(None, line), (1, line), (1, line), (2, (line + " ") * 2000), (3, None)], "doc_id long, text string")
    got = [r.doc_id for r in license_scan.scan_licenses(many).collect()]
    assert (got.count(None), got.count(1), got.count(2)) == (1, 2, 2000)
    assert license_scan.scan_licenses(none_of(docs)).count() == 0


def aligned_by_hand(words, template, start):
    """The best path through the band, cell by cell; ties go to more matches, then to the later first match."""
    band = license_scan.band_of(template)
    row = {j: (0, 0, None) for j in range(-band, band + 1)}  # score, matches, first match by offset
    best, found = 0, None
    for i, t in enumerate(template):
        new = {}
        for j in range(-band, band + 1):
            at, ways = start + i + j, [(-license_scan.GAP * (i + 1), 0, None)]
            s, m, f = row[j]
            if 0 <= at < len(words) and words[at] == t:
                ways.append((s + license_scan.MATCH, m + 1, at if f is None else f))
            else:
                ways.append((s - license_scan.REPLACE, m, f))
            if j < band:
                ways.append((row[j + 1][0] - license_scan.GAP, *row[j + 1][1:]))
            if j > -band:
                ways.append((new[j - 1][0] - license_scan.GAP, *new[j - 1][1:]))
            new[j] = max(ways, key=lambda w: (w[0], w[1], -1 if w[2] is None else w[2]))
            if new[j][0] > best:
                best, found = new[j][0], (new[j][1], new[j][2], at)
        row = new
    return found


def test_alignment_agrees_with_a_plain_one():
    rng = np.random.default_rng(5)
    for case in range(300):
        template = rng.integers(0, 4 if case % 3 else 30, rng.integers(1, 60)).astype(np.int32)
        body = [int(w) for w in template if rng.random() > 0.1]
        for _ in range(rng.integers(0, 4)):
            body.insert(rng.integers(0, len(body) + 1), int(rng.integers(-1, 30)))
        before, after = rng.integers(-1, 30, rng.integers(0, 20)).tolist(), rng.integers(-1, 30, rng.integers(0, 20)).tolist()
        words = np.array(before + body + after, dtype=np.int32)
        starts = (len(before) + rng.integers(-4, 5, rng.integers(1, 4))).tolist()
        want = [aligned_by_hand(words.tolist(), template.tolist(), s) for s in starts]
        assert license_scan.align(words, template, starts) == want, (case, template.tolist(), words.tolist(), starts)


def test_an_edited_whole_license_is_found():
    words = TEMPLATES["GPL-3.0-text"].split()
    for at in range(50, len(words), 400):
        words[at] = "changed"
    index = license_scan.Index.of(TEMPLATES)
    (found,) = license_scan.scan_texts([" ".join(words)], index, license_scan.COVERAGE)[0]
    assert found[0] == "GPL-3.0-text" and 0.98 < found[3] < 1
    template = index.words[index.names.index("GPL-3.0-text")]
    edited = template.copy()
    edited[50::400] = -1
    assert license_scan.align(edited, template, [0]) == [aligned_by_hand(edited.tolist(), template.tolist(), 0)]


def test_whole_texts_and_notices_of_relatives():
    def names(text):
        return [x[0] for x in scan([text])[0]]

    opening = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} Public License as published by the Free Software Foundation"
    assert names(opening.format("General")) == ["GPL-notice"]
    assert names(opening.format("Affero General")) == ["AGPL-notice"]
    assert names(opening.format("Unheard-of General")) == []
    later = ", either version 3 of the License, or (at your option) any later version."
    assert names(opening.format("General") + later) == ["GPL-3.0-or-later"]
    assert names(opening.format("Affero General") + later) == ["AGPL-3.0-or-later"]
    assert names("Licensed under CC BY-NC-SA 4.0.") == ["CC-BY-NC-SA-4.0-short"]
    assert names("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.") == ["CC-BY-ND-4.0"]
    assert names("This work is licensed under the GNU Lesser General Public License, version 2.1.") == ["LGPL-2.1-short"]
    whole = [n for n in TEMPLATES if n.endswith(("-text", "-notice"))]
    assert len(whole) > 30
    for n in whole:
        assert names(TEMPLATES[n]) == [n]
    # the licenses' own words, also with the holder's name and without numbered clauses
    three = TEMPLATES["BSD-3-Clause-text"].replace("the copyright holder nor", "Example Corporation nor").replace("1. ", "* ").replace("2. ", "* ")
    assert names(three) == ["BSD-3-Clause-text"]
    assert names(TEMPLATES["BSD-2-Clause-text"].replace("1. ", "- ").replace("2. ", "- ")) == ["BSD-2-Clause-text"]
    # an opening is still told from the whole
    assert names(TEMPLATES["MIT"]) == ["MIT"]


@pytest.mark.parametrize("languages", [["en", "fr"], ["de", "en", "fr"], ["de", "en", "es", "fr"]])
def test_unlearned_languages_and_lettered_junk_go(spark, languages):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    strange = [
        "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και τρέχει μακριά στο δάσος",
        "Быстрая коричневая лиса прыгает через ленивую собаку и убегает далеко в лес",
        "素早い茶色の狐がのろまな犬を飛び越えて森の中へ走り去った",
        "Szybki brązowy lis przeskakuje nad leniwym psem i ucieka daleko do lasu, gdzie żyją inne zwierzęta",
        "xqzjv kfwq zzxv bbgq wqkz pfvj qxzk vvkj hjqz xkcq zwvx qqjk",
        "QWxhZGRpbjpvcGVuIHNlc2FtZQ TWFueSBoYW5kcyBtYWtlIGxpZ2h0IHdvcms eyJhbGciOiJIUzI1NiJ9",
    ]
    learned = docs.where(docs.lang.isin(languages))
    others = docs.where(~docs.lang.isin(languages)).selectExpr("doc_id", "text", "cast(null as string) lang")
    added = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(strange)], "doc_id long, text string, lang string")
    left = {r.doc_id for r in language_id.reject_unknown(learned.unionByName(others).unionByName(added), 0.3).select("doc_id").collect()}
    assert not any(i < 0 for i in left)
    lettered = {r.doc_id for r in learned.where("regexp_count(text, '[A-Za-z]') > 0").collect()}
    assert lettered <= left
    foreign = {r.doc_id for r in others.collect()}
    assert len(foreign & left) <= 0.2 * len(foreign)


def alphabets(n: int) -> list[tuple[int, str, str]]:
    """Texts of ``n`` languages, each with words of its own."""
    rng = np.random.default_rng(1)
    rows = []
    for k in range(n):
        words = ["".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(8)]
        rows += [(len(rows) + i, " ".join(rng.permutation(words)[:6]), f"l{k:04}") for i in range(4)]
    return rows


def test_every_one_of_600_languages_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MODEL_CELLS", 1 << 22)
    rows = alphabets(600)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.train(docs)
    assert len(model.languages) == 600 and model.weights.shape == ((1 << 12) + 1, 600)
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs, model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) > 0.97 * len(rows)


def test_more_languages_than_the_bound_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MODEL_CELLS", 1 << 15)
    docs = spark.createDataFrame(alphabets(9), "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="9 languages are more than 8"):
        language_id.train(docs)


def test_the_sample_has_the_least_hashes_of_every_language(spark):
    docs = spark.range(900).selectExpr("id AS _id", "concat('t', id) AS _text", "CASE WHEN id < 800 THEN 'big' WHEN id < 890 THEN 'mid' ELSE 'few' END AS _lang")
    got = language_id.labelled_sample(docs, {"big": 800, "mid": 90, "few": 10}, 20, "_id", "_text", "_lang")
    want = []
    for lang in ("big", "few", "mid"):
        own = docs.where(f"_lang = '{lang}'").selectExpr("_text", "pmod(xxhash64(_id), 1 << 30) AS h").orderBy("h").limit(20)
        want += [(r[0], lang) for r in own.collect()]
    assert got == want


def test_statistics_are_plain_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    df, counts = language_id.document_statistics(docs)
    want, langs = np.zeros(language_id.FEATURES, dtype=int), {}
    for r in docs.collect():
        langs[r.lang] = langs.get(r.lang, 0) + 1
        want[language_id.features([r.text])[1]] += 1
    assert counts == langs and (df == want).all()


def test_ftrl_and_weights_agree_with_a_plain_version():
    rng = np.random.default_rng(3)
    rows = [(np.sort(rng.choice(30, 6, replace=False)), rng.random(6)) for _ in range(40)]
    labels, k = rng.integers(0, 3, 40), 3
    z, n = {}, {}

    def weight(f, c):
        v = z.get((f, c), 0.0)
        if abs(v) <= language_id.L1:
            return 0.0
        return -(v - math.copysign(language_id.L1, v)) / ((language_id.BETA + math.sqrt(n.get((f, c), 0.0))) / language_id.ALPHA + language_id.L2)

    order = np.random.default_rng(7)
    for _ in range(language_id.EPOCHS):
        for r in order.permutation(len(rows)):
            x = [*zip(rows[r][0].tolist(), rows[r][1].tolist()), (30, 1.0)]
            w = {(f, c): weight(f, c) for f, _ in x for c in range(k)}
            e = [math.exp(sum(v * w[f, c] for f, v in x)) for c in range(k)]
            for f, v in x:
                for c in range(k):
                    g = v * (e[c] / sum(e) - (c == labels[r]))
                    old = n.get((f, c), 0.0)
                    sigma = (math.sqrt(old + g * g) - math.sqrt(old)) / language_id.ALPHA
                    z[f, c] = z.get((f, c), 0.0) + g - sigma * w[f, c]
                    n[f, c] = old + g * g
    got = language_id.fit_ftrl(rows, labels, k, 30)
    assert np.allclose(got, [[weight(f, c) for c in range(k)] for f in range(31)], atol=1e-9)


def test_tf_idf_agrees_with_a_plain_version():
    text = "The cat. the CAT!  a"
    low = " the cat the cat a "
    counts = {}
    for size in (2, 3):
        for i in range(len(low) - size + 1):
            gram = low[i : i + size]
            if gram.strip():
                counts[gram] = counts.get(gram, 0) + 1
    row, feature, count = language_id.features([text])
    assert sorted(count.tolist()) == sorted(counts.values()) and not row.any()
    idf = np.linspace(1, 3, language_id.FEATURES)
    x = language_id.weighted(row, feature, count, idf, 1)
    raw = [(1 + math.log(c)) * idf[f] for f, c in zip(feature, count)]
    assert np.allclose(x, np.array(raw) / math.sqrt(sum(v * v for v in raw)))


def test_the_sample_leaves_the_driver_as_its_rows_come():
    """Text by text; all rows lie in two arrays, and what is known of a language is as a flag per n-gram tells."""
    texts = [f"number {i} of some short texts about {'abcdefgh'[i % 8] * 3}" for i in range(40)]
    labels = np.array([i % 2 for i in range(40)])
    idf, sample = np.linspace(1, 3, language_id.FEATURES), [(t, "xy"[k]) for t, k in zip(texts, labels)]
    rows, seen = language_id.sample_rows(sample, labels, 2, idf, 2)
    assert not sample and len({id(f.base) for f, _ in rows}) == len({id(x.base) for _, x in rows}) == 1
    has = np.zeros((2, language_id.FEATURES), dtype=bool)
    for text, k, (own, values) in zip(texts, labels, rows):
        _, f, c = language_id.features([text])
        has[k, f] = True
        want = language_id.folded(f >> 2, language_id.weighted(np.zeros(len(f), dtype=np.int64), f, c, idf, 1))
        assert own.tolist() == want[0].tolist() and values.tolist() == want[1].tolist()
    assert (np.packbits(has, axis=1) == seen).all()
