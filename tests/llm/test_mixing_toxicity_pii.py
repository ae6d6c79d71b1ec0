import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import mixing, pii, queries, toxicity

SF = "/root/testdata/sf0.001"


# ---- mixing ---------------------------------------------------------------
def _uniform(seed, doc, part):
    return int(hashlib.md5(f"{seed}:{doc}:{part}".encode()).hexdigest()[:13], 16) / 16 ** 13


def _poisson(u, mean):
    k, term = 0, math.exp(-mean)
    total = term
    while total <= u and total + term * mean / (k + 1) > total or k < mean and total <= u:
        k += 1
        term *= mean / k
        total += term
    return k if total > u else k + 1


def test_copies_by_brute_force(make_docs, awkward):
    rows = [(d, t, s) for (d, t), s in zip(awkward, ["src0", "src1", None, "other"] * 4)] + [(100 + i, f"t{i}", "src0") for i in range(60)]
    weights = {"src0": 1.0, "src1": 40.0, "absent": 5.0}
    counts = Counter(r[2] for r in rows)
    total = counts["src0"] + counts["src1"]
    means = {s: weights[s] / 41 * total / counts[s] for s in ("src0", "src1")}
    want = Counter()
    for d, t, s in rows:
        want[d, t, s] += _poisson(_uniform(3, "null" if d is None else d, 1), means.get(s, 1.0))
    docs = make_docs(rows)
    mixed = mixing.mix(docs.repartition(3), weights, seed=3)
    assert mixed.columns == [c for c in docs.columns if c != "copies"] + ["copies", "copy", "shuffle_key"]
    got = mixed.collect()
    assert Counter((r.doc_id, r.text, r.source) for r in got) == +want
    by_row = defaultdict(list)
    for r in got:
        by_row[r.doc_id, r.text, r.source].append(r)
    for (d, t, s), copies in by_row.items():
        repeated = sum((x, y, z) == (d, t, s) for x, y, z in rows)
        assert sorted(r.copy for r in copies) == sorted(list(range(1, copies[0].copies + 1)) * repeated)
    keys = [r.shuffle_key for r in got]
    assert keys == sorted(keys)  # partitions are in order, and sorted inside


def test_shares_reach_their_targets(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "a").otherwise("b").alias("source"))
    got = dict(Counter(r.source for r in mixing.mix(docs, {"a": 1.0, "b": 3.0}).collect()))
    assert abs(got["a"] - 7_500) < 400 and abs(got["b"] - 22_500) < 800


def test_rows_without_an_id_reach_their_rate(spark, tmp_path):
    """In the registered query and the pipeline's stage; the same for any partitioning."""
    docs = spark.range(8000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"), F.lit("en").alias("lang"),
                                    F.when(F.col("id") % 4 == 0, "src0").when(F.col("id") % 4 < 3, "src1").otherwise("other").alias("source"),
                                    F.lit(7).cast("long").alias("n_chars"))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = {"src0": 4000, "src1": 2000, "other": 2000}
    for mixed in (queries.op3_mixing(spark, str(tmp_path)), corpus_pipeline.mix_sources(spark, docs, str(tmp_path))):
        got = Counter(r.source for r in mixed.select("source").collect())
        assert all(abs(got[s] - n) < 300 for s, n in want.items())
    runs = [Counter((r.text, r.copy, r.shuffle_key) for r in mixing.mix(docs.repartition(p), {"src0": 2.0, "src1": 1.0}, null_ids="row").collect()) for p in (1, 5)]
    assert runs[0] == runs[1] and len({k for *_, k in runs[0]}) == len(runs[0])


def test_large_means_and_nothing(spark, make_docs):
    docs = spark.createDataFrame([(1, "rare")] + [(i, "common") for i in range(2, 3002)], "doc_id long, source string")
    copies = {r.source: r.copies for r in mixing.with_copies(docs, {"rare": 1.0, "common": 1.0}, 1).where("source = 'rare'").collect()}
    assert abs(copies["rare"] - 1500.5) < 200
    assert mixing.mix(make_docs([]), {"src0": 1.0}).collect() == []
    assert mixing.poisson_table(0.0)[0] == 1.0


# ---- toxicity -------------------------------------------------------------
def _corpus(n):
    rng = random.Random(9)
    words = [a + b for a in ("ba", "do", "ki", "lu", "me", "no") for b in ("rin", "sol", "tam", "ver", "wik", "zan")]
    rows, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = rng.random() < 0.2
        if toxic:
            for w in rng.sample(("vilefool", "rotten", "cursedly", "nastier"), 2):
                text.insert(rng.randrange(len(text)), w)
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows(spark, make_docs):
    rows, labels = _corpus(1500)
    docs = make_docs(rows)
    model = toxicity.train(docs, spark.createDataFrame([(l, "x", d) for d, l in labels], "toxic int, text string, doc_id long"))
    got = {r.doc_id: r.score for r in toxicity.score(docs, model, into="new").select("doc_id", F.col("new").alias("score")).collect()}
    unseen = [(got[d], l) for d, l in labels if zlib.crc32(str(d).encode()) % 3 == 1]
    assert sum((s >= 0.7) == bool(l) for s, l in unseen) / len(unseen) > 0.97
    held = {r.doc_id for r in docs.where(toxicity.is_held_out(F.col("doc_id"))).collect()}
    assert held == {d for d, _ in labels if zlib.crc32(str(d).encode()) % 3 == 1}


def test_scores_depend_on_text_and_training_rows_only(spark, make_docs):
    rows, labels = _corpus(400)
    flipped = [(d, 1 - l if zlib.crc32(str(d).encode()) % 3 == 1 else l) for d, l in labels]
    frames = [spark.createDataFrame(x, "doc_id long, toxic int").repartition(p) for x, p in ((labels, 1), (flipped, 5))]
    scores = [{r.doc_id: r.new for r in toxicity.score(make_docs(rows), toxicity.train(make_docs(rows).repartition(p), f), into="new").collect()}
              for f, p in zip(frames, (2, 7))]
    assert scores[0] == pytest.approx(scores[1], abs=1e-6)


def test_awkward_rows_and_labels(spark, make_docs, awkward):
    docs = make_docs(awkward)
    kinds = "doc_id long, toxic int"
    for labels in ([], [(1, 1)], [(3, None), (None, 1), (2, 0)], [(d, i % 2) for i, (d, _) in enumerate(awkward)], [(6, 1), (6, 1), (7, 0), (8, 0), (9, 2)]):
        model = toxicity.train(docs, spark.createDataFrame(labels, kinds))
        scored = toxicity.score(docs, model)
        assert sorted(scored.columns) == sorted(docs.columns)
        got = scored.collect()
        assert len(got) == len(awkward) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if not (r.text or "").strip()}) == 1
    assert toxicity.score(make_docs([]), model).collect() == []


def test_pairwise_interactions_are_learned():
    """Either term alone is harmless, both together are not."""
    terms = np.arange(3)
    rows, labels = [], []
    for i in range(400):
        a, b = i % 2, i // 2 % 2
        rows.append([0] * a + [1] * b + [2])
        labels.append(float(a and b))
    rows = [sorted(set(t for t, on in zip((0, 1, 2), (i % 2, i // 2 % 2, 1)) if on)) for i in range(400)]
    ends = np.cumsum([len(r) for r in rows])
    ids = np.concatenate([np.array(r) for r in rows])
    model = toxicity.fit(terms, ends, ids, np.ones(len(ids), np.float32), np.array(labels), rate=0.5)
    raw = [model.raw(np.array(r), np.ones(len(r), np.float32), np.array([0]))[0] for r in ([2], [0, 2], [1, 2], [0, 1, 2])]
    assert raw[3] > 1 and max(raw[:3]) < -1


# ---- surrogates -----------------------------------------------------------
KEY = b"test key"
TEXTS = [
    "Call Mr. John Smith or Mrs. Alice O'Neil at +1 (509) 555-6973 or jon.DOE+x@mail3.example.com.",
    "JON.doe+x@mail3.example.com, +1-509-555-6973; 4111 1111 1111 1111 and 4111111111111111, 10.0.0.255, 123-45-6789",
    "Mr. Smith met Alice O'Neil. Госпожа Анна Петрова; Господин Петрова.",
    "version 1.2.3.4.5 of 2024, 3.14159, and token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\"",
]


def test_surrogates_keep_type_format_and_coreference(spark, make_docs):
    got = {r.doc_id: r for r in pii.replace_entities(make_docs(list(enumerate(TEXTS))), KEY).collect()}
    new = {(i, e.kind, TEXTS[i][e.start:e.end]): r.text[e.new_start:e.new_end] for i, r in got.items() for e in r.entities}
    assert all(v != k[2] for k, v in new.items())
    assert new[0, "email", "jon.DOE+x@mail3.example.com"].lower() == new[1, "email", "JON.doe+x@mail3.example.com"].lower()
    assert re.sub(r"\D", "", new[0, "phone", "+1 (509) 555-6973"]) == re.sub(r"\D", "", new[1, "phone", "+1-509-555-6973"])
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", new[0, "phone", "+1 (509) 555-6973"])
    card = new[1, "card", "4111 1111 1111 1111"]
    assert re.fullmatch(r"(\d{4} ){3}\d{4}", card) and card.replace(" ", "") == new[1, "card", "4111111111111111"] and pii._luhn(card.replace(" ", ""))
    assert all(0 <= int(o) <= 255 for o in new[1, "ip", "10.0.0.255"].split("."))
    assert new[0, "surname", "Smith"] == new[2, "surname", "Smith"] and new[0, "surname", "O'Neil"] == new[2, "surname", "O'Neil"]
    assert new[0, "given-f", "Alice"] in pii.GIVEN["latin"]["f"] and new[2, "given-f", "Анна"] in pii.GIVEN["cyrillic"]["f"]
    assert re.fullmatch("[А-Я][а-я]{6}", new[2, "surname", "Петрова"])
    assert "version 1.2.3.4.5 of 2024, 3.14159" in got[3].text and re.search('"[0-9a-f]{40}"', got[3].text)
    for i, r in got.items():  # the rest of the text is untouched
        rest = [re.split("|".join(re.escape(t[a:b]) for a, b in spans), t) if spans else [t]
                for t, spans in ((TEXTS[i], [(e.start, e.end) for e in r.entities]), (r.text, [(e.new_start, e.new_end) for e in r.entities]))]
        assert rest[0] == rest[1]


def test_distinct_entities_get_distinct_surrogates():
    for kind, entities in (("email", [f"{a}{b}@x{c}.org" for a in "abcde" for b in range(10) for c in range(10)]),
                           ("phone", [f"+1509555{i:04d}" for i in range(500)]), ("ip", [f"10.0.{i}.{j}" for i in range(20) for j in range(20)]),
                           ("card", [f"{i:016d}" for i in range(0, 4000, 7)]), ("surname", ["miller", "moller", "meller", "baker", "beker", "o'neil"]),
                           ("given-m", [n.lower() for n in pii.GIVEN["latin"]["m"]])):
        got = [pii.surrogate(KEY, kind, e) for e in entities]
        assert len(set(got)) == len(entities)
        assert got != [pii.surrogate(b"another key", kind, e) for e in entities]


def test_permutation_is_one_to_one():
    for n in (1, 2, 10, 26, 1000):
        assert sorted(pii.Permutation(KEY, "t", n)(x) for x in range(n)) == list(range(n))


def test_clashes_are_drawn_again(spark, make_docs):
    """A corpus that holds every string of a small pattern: surrogates would hit real entities or themselves, so many clash."""
    emails = [f"{a}@x.org" for a in "bcdfg"]
    distinct = spark.createDataFrame([("email", e) for e in emails], "kind string, entity string")
    again = {(r.kind, r.entity): r.attempt for r in pii.redrawn(distinct, KEY).collect()}
    final = [pii.surrogate(KEY, "email", e, again.get(("email", e), 0)) for e in emails]
    assert len(set(final)) == len(emails) and not set(final) & set(emails)
    # both ways to hand out redrawn entities give the same texts
    names = [(i, f"Dr. {n} Ab called Mr. Eb and Mrs. {n}") for i, n in enumerate(("Ba", "Be", "Bi", "Bo", "Bu", "By", "Ca", "Ce"))]
    small = pii.replace_entities(make_docs(names + [(None, None)]), KEY)
    joined = pii.replace_entities(make_docs(names + [(None, None)]), KEY, max_redrawn=-1)
    assert sorted(map(str, small.collect())) == sorted(map(str, joined.collect()))


def test_every_name_gets_a_surrogate(spark, make_docs):
    """Scripts without vowel and consonant classes, and more two-letter surnames than half their pattern has strings."""
    others = ["Dr. 王明", "Dr. שמעון", "Prof. Đỗ", "Dr. ½½", "Mr. Đặng 王明 x", "Mr. 李四 came"]
    short = [a + b for a in "bcdfghjklmnpqrstvwxz" for b in "aeiouy"][:110]
    vowels = [a + b for a in "aeiou" for b in "aeiou"]
    rows = list(enumerate(others)) + [(100 + i, f"Mr. {n.title()}") for i, n in enumerate(short + vowels)]
    got = {r.doc_id: r for r in pii.replace_entities(make_docs(rows), KEY).collect()}
    assert len(got) == len(rows) and all(got[i].entities for i, _ in rows)
    for i, text in rows:
        for e in got[i].entities:
            assert text[e.start:e.end] != got[i].text[e.new_start:e.new_end]
    new = [got[i].text[4:].lower() for i, _ in rows if i >= 100]
    assert len(set(new)) == len(new) and not set(new) & set(short + vowels)
    assert re.fullmatch("Dr\\. [\u4e00-\u9fff]{2}", got[0].text) and re.fullmatch("Dr\\. [\u05d0-\u05f2]{5}", got[1].text)
    # longer surrogates of emails and phone numbers are written out in full
    for kind, text in (("email", "A@b.de"), ("phone", "+1 1 22 33")):
        long = pii.surrogate(KEY, kind, pii.canonical(kind, text), pii.OWN_DRAWS)
        assert len(long) == len(pii.canonical(kind, text)) + pii.LONGER and pii.canonical(kind, pii._laid_out(kind, text, long)) == long


def test_further_forms_are_found():
    for text, kind in (("3782 822463 10005", "card"), ("3782-822463-10005", "card"), ("509 555 0100", "phone"), ("1-800-555-0100", "phone"),
                       ("509.555-0100", "phone"), ("020 7946 0958", "phone"), ("0171 1234567", "phone"), ("2001:db8::8a2e:370:7334", "ip"),
                       ("2001:0db8:0000:0000:0000:8a2e:0370:7334", "ip"), ("fe80::1", "ip"), ("10.0.0.255", "ip"), ("123-45-6789", "ssn")):
        for before, after in (("", ""), ("call ", "."), ("(", "), then"), ("at ", ": no")):
            assert [(before + text + after)[a:b] + k for a, b, k, _ in pii.detect(before + text + after)] == [text + kind], before + text + after
        entity = pii.detect(text)[0][3]
        new = pii._laid_out(kind, text, pii.surrogate(KEY, kind, entity))
        assert new != text and [(k, len(e) if k != "ip" else 0) for *_, k, e in pii.detect(new)] == [(kind, len(entity) if kind != "ip" else 0)]
    for text in ("at 12:30:45", "std::vector", "x[::2]", "2024-01-02 10:20:30", "a::b", "1 000 000", "07 04 2021"):
        assert pii.detect(text) == []
    assert pii.canonical("phone", "1-800-555-0100") == pii.canonical("phone", "+1 (800) 555-0100")
    assert pii.canonical("ip", "2001:0db8::1") == pii.canonical("ip", "2001:DB8:0::1")


def test_a_possessive_is_the_same_name():
    texts = ("Mr Smith's dog", "Mr Smith’s Dog", "MR Smith", "Mr Smith", "Mr John Smith's", "Alice Smith's", "Mrs. O'Neil's")
    assert [[e for *_, k, e in pii.detect(t) if k == "surname"] for t in texts] == [["smith"], ["smith"], [], ["smith"], ["smith"], ["smith"], ["o'neil"]]


def test_awkward_texts(make_docs, awkward):
    rows = awkward + [(50, TEXTS[0]), (50, TEXTS[0]), (None, TEXTS[1])]
    got = pii.replace_entities(make_docs(rows), KEY).collect()
    assert len(got) == len(rows)
    untouched = Counter((r.doc_id, r.text) for r in got if not r.entities)
    assert untouched == Counter(awkward)
    assert len({r.text for r in got if r.doc_id == 50}) == 1
    assert pii.replace_entities(make_docs([]), KEY).collect() == []


def test_the_key_comes_from_the_session(spark):
    spark.conf.unset(queries.PII_KEY_SETTING)
    assert queries.pii_key(spark) != queries.pii_key(spark) and len(queries.pii_key(spark)) == 32
    spark.conf.set(queries.PII_KEY_SETTING, "secret")
    try:
        assert queries.pii_key(spark) == b"secret"
        rows = [sorted((r.doc_id, r.n_entities, r.kinds, r.text) for r in queries.op10_pii(spark, SF).collect()) for _ in range(2)]
        assert rows[0] == rows[1]
        texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
        found = {d: pii.detect(t or "") for d, t in texts.items()}
        for doc, n, kinds, text in rows[0]:   # the registered contract: every mention replaced, the rest as it was
            assert n == len(found[doc]) and kinds == ",".join(sorted({k for *_, k, _ in found[doc]}))
            assert (text == texts[doc]) == (n == 0)
            assert all(texts[doc][a:b] not in text or len(texts[doc][a:b]) < 6 for a, b, k, _ in found[doc] if k in ("email", "card"))
    finally:
        spark.conf.unset(queries.PII_KEY_SETTING)


LABELLED = [
    ("Write to {} today.", "email", ["jo.b@example.org", "a+tag@sub.example.co.uk", "X_1@example.com"]),
    ("Call {} now.", "phone", ["+1 (509) 555-0100", "509-555-0100", "+44 20 7946 0958", "020 7946 0958", "1-800-555-0100"]),
    ("Card {} was used.", "card", ["4111 1111 1111 1111", "5500-0000-0000-0004", "3782 822463 10005"]),
    ("Host {} answered.", "ip", ["192.0.2.17", "2001:db8::8a2e:370:7334"]),
    ("SSN {} on file.", "ssn", ["123-45-6789"]),
    ("We met Dr. {} there.", "surname", ["Smith", "O'Neil", "Иванов"]),
]
CLEAN = ["Order 12345 of 2024-05-06 cost 99.50 EUR.", "Version 10.2.3 of the tool.", "Room 4111, floor 11.", "No names in here at all.", "e = mc2 @ home", "12:30 to 14:45"]


def test_detection_over_a_labelled_sample():
    """Recall over every labelled mention in every sentence, and nothing found in clean ones."""
    hit = total = 0
    for frame, kind, values in LABELLED:
        for value in values:
            text = frame.format(value)
            total += 1
            hit += any(text[a:b] == value and k == kind for a, b, k, _ in pii.detect(text))
    assert hit / total >= 0.95, (hit, total)
    assert [pii.detect(t) for t in CLEAN] == [[]] * len(CLEAN)


def test_registered_toxicity_contract(spark):
    got = queries.op1_toxicity(spark, SF)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and got.schema["held_out"].dataType.simpleString() == "boolean"
    rows = got.collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
