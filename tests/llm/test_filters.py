import hashlib
import pickle
import random
import re
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from jobtide.llm import decontaminate, licenses, neighbours, pii, toxicity


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c)
        total += (v * 2 - 9 if v > 4 else v * 2) if i % 2 else v
    return total % 10 == 0


def base_spans(text):
    """The stated patterns as they are written, with Python's matcher."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


def pii_texts():
    rng = random.Random(5)
    pieces = ["a.b@c.de", "@", "x@y", "a@b.c@d.e", "q_%+-@z-1.co.uk.", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.0255", "4111 1111 1111 1111",
              "4111-1111-1111-1111", "4111111111111111", "4111111111111112", "4111  1111", "+1 (255) 555-8013", "+1", "++49 30 123456", "+1.2.3.4", "+4111 1111 1111 1111",
              "+123456789012345678", "word", "é🙂", " ", "  ", "\n", "-", ".", "5", "12", "+", "5@6.7.8.9"]
    return ["".join(rng.choice(pieces) + rng.choice(["", " ", " "]) for _ in range(rng.randint(1, 12))) for _ in range(500)]


def test_base_patterns(spark, rows):
    texts = [*pii_texts(), *[r[1] for r in rows], "7" * 50_000, "a" * 100_000 + "@b", "+1" + " " * 50_000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.digest(pii.find(docs)).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        spans = base_spans(text or "")
        written = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(written).encode()).hexdigest(), text
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert set(written) <= set(filter(None, got[i]["spans"].split(",")))


def test_contexts_discover_unseen_identifiers(spark):
    seen = [(i, f"please dial +1 255 555 {8000 + i} today ok") for i in range(12)]
    fresh = [(100, "we say dial 0711-4447-199 today again"), (101, "please dial nothing today"), (102, "the 0711-4447-198 box")]
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(spark.createDataFrame(seen + fresh, "doc_id long, text string"))).collect()}
    text = fresh[0][1]
    start = text.index("0711")
    assert got[100] == f"phone:{start}:{start + 13}" and got[101] == "" and got[102] == ""
    assert all(got[i].startswith("phone:12:") for i in range(12))


def test_contexts_discover_spaced_and_at_identifiers(spark):
    seen = [f"please dial +1 255 555 {8000 + i} today ok" for i in range(12)] + [f"write to user{i}@mail.example.com for more" for i in range(12)]
    seen += [f"host sits on 10.0.0.{i} behind nat" for i in range(12)]
    fresh = {"please dial 0711 4447 199 today again": "phone:0711 4447 199", "write to jo.doe(at)mail.com for more": "email:jo.doe(at)mail.com",
             "write to jo.roe[at]mail.com for more": "email:jo.roe[at]mail.com", "host sits on fe:ab:cd:ef:ad:be:ca:da behind nat": "ip:fe:ab:cd:ef:ad:be:ca:da",
             "the 0711 4447 198 box": "", "please dial nothing today": ""}
    rows = list(enumerate([*seen, *fresh]))
    got = {r["doc_id"]: r["spans"] for r in pii.digest(pii.find(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    for i, text in rows[len(seen):]:
        kind, _, found = fresh[text].partition(":")
        start = text.index(found)
        assert got[i] == (f"{kind}:{start}:{start + len(found)}" if found else ""), text


def test_redaction(spark, docs, rows):
    texts = [(1, "mail a@b.cd or 1.2.3.4!"), (1, "mail a@b.cd or 1.2.3.4!"), (2, None), (None, "x +1 255 555 8013"), (4, "+1.2.3.4 5678 é a@b.cd🙂")]
    got = pii.redact(spark.createDataFrame([(*t, 0, "s") for t in texts], "doc_id long, text string, n_chars long, _spans string"))
    assert got.columns == ["doc_id", "text", "n_chars", "_spans"]
    assert Counter((r[0], r[1], r[2]) for r in got.collect()) == Counter({
        (1, "mail <EMAIL> or <IP>!", 21): 2, (2, None, 0): 1, (None, "x <PHONE>", 9): 1, (4, "<PHONE> é <EMAIL>🙂", 18): 1})
    assert pii.redact(docs).count() == len(rows)
    assert pii.digest(pii.find(docs)).count() == len(rows) and pii.digest(pii.find(docs.limit(0))).collect() == []


INSULTS = ["moron", "clownface", "scumbag"]


def toxic_rows():
    rng = random.Random(11)
    say = lambda: [rng.choice(["the", "onthe", "ering", "hand", "shanor", "blent", "tionly", "wher", "eastan", "ofed"]) + rng.choice(["", "er", "ing", "ly"]) for _ in range(rng.randint(4, 25))]
    rows = []
    for i in range(600):
        words = say()
        toxic = i % 5 == 0
        if toxic:
            words.insert(rng.randrange(len(words)), INSULTS[i // 5 % 3])
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_learns_and_tolerates_gaps(spark, docs, no_docs):
    rows = toxic_rows()
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = table.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (5, None), (9999, 1)], "doc_id long, toxic int"))
    model = toxicity.train(table.select("doc_id", "text"), labels, F.col("doc_id") % 4 != 0)
    odd = ["Moron!", "m o r o n", "m.o.r.o.n", "moroon", "m0ron", "Scum-bag", "hand", "", None, "🙂", "a " * 10 + "moron"]
    got = toxicity.score(spark.createDataFrame([(i, t) for i, t in enumerate(odd)], "doc_id long, text string"), model).collect()
    assert [r["toxicity"] >= 0.5 for r in got] == [True] * 6 + [False] * 4 + [True]
    held = toxicity.score(table.filter("doc_id % 4 = 0"), model).collect()
    assert np.mean([(r["toxicity"] >= 0.5) == r["toxic"] for r in held]) > 0.98
    scored = toxicity.score(docs, model)
    assert scored.columns == [*docs.columns, "toxicity"] and scored.filter("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
    assert toxicity.score(no_docs, model).count() == 0
    for only in (0, 1):  # one class, and none
        flat = toxicity.train(table.select("doc_id", "text"), labels.filter(f"toxic = {only}"), F.lit(True))
        assert {r[0] >= 0.5 for r in toxicity.score(table, flat).select("toxicity").collect()} == {bool(only)}
    assert toxicity.train(no_docs, labels.limit(0), F.lit(True)).scores([b"x"])[0] < 0.5


@pytest.mark.parametrize(("insult", "odd", "clean"), [
    ("придурок", ["Придурок!", "п р и д у р о к", "при.дурок"], "слово погода работа город деньги книга"), ("żółćłeb", ["ŻÓŁĆŁEB", "ż.ó.ł.ć.ł.e.b", "zolcleb"], "łąka świat ręka człowiek morze šum"),
    ("βλακας", ["ΒΛΑΚΑΣ", "βλά-κας"], "θαλασσα ημερα δρομος βιβλιο"), ("حمارغبي", ["حمار-غبي"], "كتاب مدينة شارع عمل"), ("笨蛋傻瓜", ["笨蛋傻瓜"], "天气 很好 城市 工作 朋友")])
def test_toxic_words_of_other_scripts(insult, odd, clean):
    rng = random.Random(3)
    rows = []
    for i in range(400):
        words = [rng.choice(clean.split()) for _ in range(rng.randint(3, 12))]
        if i % 4 == 0:
            words.insert(rng.randrange(len(words)), insult)
        rows.append((" ".join([*words, f"t{rng.choice('bcdfg')}x"]).encode(), i % 4 == 0))
    model = toxicity.fit([t for t, _ in rows], np.array([x for _, x in rows]))
    assert (model.scores([x.encode() for x in [insult, *odd]]) >= 0.5).all()
    assert (model.scores([x.encode() for x in [clean, "", "🙂️"]]) < 0.5).all()


def test_letters_of_words():
    texts = ["Łódź œuvre ﬁn ｆｕｌｌ šum é ß m0ron", "a\u00a0b\u3000c ½ ´ 🙂️ \u200d", "plain T3xt!"]
    assert toxicity._plain([t.encode() for t in texts]) == [b"lodz oeuvre fin full sum e s moron", b"a b c    ", b"plain text"]


def test_margins_follow_the_kernel():
    words = [b"moron", b"ab", b"clownface"]
    letters, sizes = np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words])
    marks = toxicity._vectors([b"moron", b"clown"])
    kernel = toxicity._kernel(words, marks)
    for column in range(2):
        assert toxicity.margins(letters, sizes, marks[column].astype(float), 0.0) == pytest.approx(kernel[:, column], rel=1e-4)
    long = b"abcdefghmoronijklmnopqrstuvw"  # half-overlapping windows of 16, the best of which counts
    parts = toxicity._kernel([long[:16], long[8:24], long[16:]], marks)
    assert toxicity.margins(np.frombuffer(long, np.uint8), np.array([len(long)]), marks[0].astype(float), 0.0) == pytest.approx(parts[:, 0].max(), rel=1e-4)
    assert kernel[0, 0] == pytest.approx(np.square(marks[0]).sum(), rel=1e-4)


@pytest.mark.parametrize("at", [0, 13, 30, 52])
def test_insults_anywhere_in_a_text_without_blanks(at):
    rng, insult = random.Random(8), "笨蛋傻瓜"
    common = [chr(0x4E00 + 37 * i) for i in range(400)]
    rows = []
    for i in range(600):
        text = [rng.choice(common) for _ in range(60)]
        if i % 2:
            text[at : at + 4] = insult
        rows.append(("".join(text).encode(), bool(i % 2)))
    model = toxicity.fit([t for t, _ in rows[:400]], np.array([x for _, x in rows[:400]]))
    found = model.scores([t for t, _ in rows[400:]]) >= 0.5
    assert np.mean(found == [x for _, x in rows[400:]]) > 0.95


def test_units_are_words_and_windows():
    words = toxicity.Words([b"ab abcdefghijklmnopqrstuvwx ab", b"", b"ab qrstuvwx"])
    letters, sizes, owner, unit = toxicity._units(words)
    ends = np.cumsum(sizes)
    spelled = [letters[e - n : e].tobytes() for n, e in zip(sizes, ends)]
    assert sorted({(int(o), spelled[u]) for o, u in zip(owner, unit)}) == [(0, b"ab"), (0, b"abcdefghijklmnop"), (0, b"ijklmnopqrstuvwx"), (2, b"ab"), (2, b"qrstuvwx")]
    assert len(owner) == 5 and len(toxicity._units(toxicity.Words([b"", b" "]))[2]) == 0


def distance_in(item, text):
    """Least edits between the item and any stretch of the text, by the plain recursion."""
    last = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[j - 1] + 1))
        last = row
    return min(last)


def test_passages_within_the_budget(spark, docs, no_docs):
    rng = random.Random(2)
    say = lambda n: " ".join("".join(rng.choice("abcdeñ日") for _ in range(rng.randint(1, 8))) for _ in range(n))
    items = [(0, say(20)), (1, say(12)), (2, say(150)), (3, "tiny"), (4, ""), (5, None), (6, say(12).upper()), (0, None)]

    def edited(text, edits):
        text = list(text)
        for _ in range(edits):
            at = rng.randrange(len(text))
            text[at : at + 1] = rng.choice([[], ["x"], [text[at], "y"]])
        return "".join(text)

    texts = []
    for item_id, text in items:
        for share in (0, 0.03, 0.09, 0.13, 0.3):
            if text:
                texts.append(f"{say(6)}\n{edited(text, int(len(text) * share))}\t{say(4)}")
    texts += [None, "", "a", say(400), items[0][1][: len(items[0][1]) // 2], (items[1][1] + " ") * 3]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for item_bytes in (1 << 20, 300):  # one part, and several
        found = decontaminate.find_passages(table, benchmark, item_bytes=item_bytes).collect()
        index = decontaminate.Index([i for i in items if i[1]])
        expected = {}
        for d, text in enumerate(texts):
            for n, item_id in enumerate(index.ids):
                edits = distance_in(index.texts[n], decontaminate.folded(text or ""))
                if edits <= index.budget[n]:
                    expected[d, item_id] = edits
        assert {(r["doc_id"], r["item_id"]) for r in found} == set(expected)
        assert {k: min(r["edits"] for r in found if (r["doc_id"], r["item_id"]) == k) for k in expected} == expected
        for r in found:
            stretch = decontaminate.folded(texts[r["doc_id"]])[r["start"] : r["end"]]
            assert min(distance_in(index.texts[n], stretch) for n, i in enumerate(index.ids) if i == r["item_id"]) <= r["edits"]
        assert sum(r["doc_id"] == len(texts) - 1 and r["item_id"] == 1 for r in found) == 3
    clean = decontaminate.drop_contaminated(table, benchmark)
    assert {r[0] for r in clean.select("doc_id").collect()} == set(range(len(texts))) - {d for d, _ in expected}
    assert decontaminate.find_passages(no_docs, benchmark).collect() == []
    none = benchmark.limit(0)
    assert decontaminate.find_passages(docs, none).collect() == [] and decontaminate.drop_contaminated(docs, none).count() == docs.count()


def places_in(index, n, text):
    """Every place within an item's budget by the whole table of edits, the best of those that overlap."""
    item, k, step = index.texts[n], int(index.budget[n]), 1 << 32
    last = [j for j in range(len(text) + 1)]  # cost above, start below
    for i, a in enumerate(item, 1):
        row = [i * step]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b) * step, last[j] + step, row[j - 1] + step))
        last = row
    near = sorted((c >> 32, c & (step - 1), j) for j, c in enumerate(last) if c >> 32 <= k)
    out = []
    for edits, a, b in near:
        if all(b <= s or e <= a for s, e, _ in out):
            out.append((a, b, edits))
    return sorted(out)


def test_every_place_once():
    rng = random.Random(9)
    cases = [("ab cd ef " * 10, "ab cd ef " * 120), ("hello world ", "hello world " * 3), ("abcdefgh", "abcdefghabcdefgh abcdefgh"),
             ("abababababababababab", "ab" * 45), ("the quick brown fox", "the quick brown fox the quikc brown fox. the quick brown fo the quick brownfox")]
    for _ in range(40):
        piece = "".join(rng.choice("ab ") for _ in range(rng.randint(2, 7)))
        item = (piece * 30)[: rng.randint(9, 60)]
        text = list("".join(rng.choice(["", "b", "aab "]) + item[: rng.randint(5, 60)] for _ in range(8)))
        for _ in range(rng.randrange(6)):
            text[rng.randrange(len(text))] = rng.choice(["", "a", "ab", "x"])
        cases.append((item, "".join(text)))
    for item, text in cases:
        index = decontaminate.Index([(7, item)])
        found = [r[2:] for r in index.find([b"nothing", text.encode()])]
        assert found == places_in(index, 0, decontaminate.folded(text))
        assert all(r[:2] == (1, 0) for r in index.find([b"nothing", text.encode()]))


def test_licences_inside_others(spark):
    full = {n: " ".join(licenses.SENTENCES[i][-1] for i in sequence) for n, sure, sequence in licenses.RULES if sure == "full"}
    three, two, mit = full["BSD-3-Clause"], full["BSD-2-Clause"], full["MIT"]
    first, *rest = [licenses.SENTENCES[i][0] for i in ("bsd-redistribute", "bsd-source", "bsd-binary")]
    texts = [three, two, f"{three}\n\n{two}", f"{two}\n\n{three}", f"{three} {three}", f"{mit}\n\n{mit}", f"{first} {mit} {' '.join(rest)}", f"{first}\n{three}"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["licences"] for r in got] == ["BSD-3-Clause", "BSD-2-Clause", "BSD-3-Clause,BSD-2-Clause", "BSD-3-Clause,BSD-2-Clause", "BSD-3-Clause", "MIT", "MIT,BSD-2-Clause", "BSD-3-Clause,BSD-2-Clause"]


def test_the_licence_twin_knows_the_same(spark):
    """The SQL twin over cut, wrapped and combined sentences, beside the scan."""
    import duckdb
    import pandas as pd

    texts = [None, "", "x"]
    for name, sentences in licenses.SENTENCES.items():
        for s in sentences:
            texts += [s, wrapped(s, 30), wrapped(s, 30, "// "), f"a {s} b", f"\x1d{s}\x1f", s.upper(), f"{s} {licenses.SENTENCES['mit-ref'][0]}\n\n{s}"]
    texts += [" ".join(licenses.SENTENCES[i][0] for i in sequence) + "\n" + wrapped(texts[7], 20) for _, _, sequence in licenses.RULES]
    rows = pd.DataFrame({"doc_id": range(len(texts)), "text": texts})
    with duckdb.connect() as db:
        db.register("documents", rows)
        twin = sorted(db.sql(licenses.sql_twin()).fetchall())
    found = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert sorted(tuple(r) for r in found.collect()) == twin and sum(bool(r[2]) for r in twin) > 100


def test_licences(spark, docs, rows, no_docs):
    mit = "\n".join(licenses.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "mit-warranty"))
    texts = ["Licensed under CC BY-NC 4.0.\nTh ndinly", mit, mit.replace("furnished to do so", "furnished\nto do so"), "All rights reserved", "nothing here. licence", None, "",
             licenses.SENTENCES["mit-warranty"][0] + "\n" + licenses.SENTENCES["mit-grant"][0], "x. Released under the MIT License! Licensed under the Apache License, Version 2.0."]
    got = [r["licences"] for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert got == ["CC-BY-NC-4.0", "MIT", "MIT", "Proprietary", "", "", "", "MIT", "MIT,Apache-2.0"]
    assert licenses.scan(docs).count() == len(rows) and licenses.scan(no_docs).count() == 0


def wrapped(text, width, start=""):
    lines, line = [], ""
    for word in text.split():
        if line and len(line) + len(word) >= width:
            lines, line = [*lines, line], word
        else:
            line = f"{line} {word}".strip()
    return "\n".join(start + x for x in [*lines, line])


def test_every_licence_sentence_and_rule_plain_and_wrapped(spark):
    shapes = [lambda s: s, lambda s: wrapped(s, 1), lambda s: wrapped(s, 30), lambda s: wrapped(s, 72), lambda s: wrapped(s, 72).replace("\n", "\r\n"),
              lambda s: wrapped(s, 60, "// "), lambda s: wrapped(s, 60, " * "), lambda s: wrapped(s, 60, "-- "), lambda s: f"Some words\n\n{wrapped(s, 50)}\n\nand more."]
    cases = [(shape(s), name) for name, texts in licenses.SENTENCES.items() if name not in ("apache2-use", "apache2-copy") for s in texts for shape in shapes]
    cases += [(shape(" ".join(licenses.SENTENCES[i][-1] for i in sequence)), ",".join(sequence)) for _, _, sequence in licenses.RULES for shape in shapes]
    got = licenses.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()
    found = {r["doc_id"]: r for r in got}
    assert [(t, found[i]["sentence_ids"]) for i, (t, _) in enumerate(cases)] == cases
    rules = {",".join(sequence): name for name, _, sequence in reversed(licenses.RULES)}
    assert all(found[i]["licences"].split(",")[0] == rules[ids] for i, (_, ids) in enumerate(cases) if ids in rules)


def test_licence_sentences_end_at_cuts(spark):
    texts = ["Licensed under the. MIT License.", "Not Licensed under the MIT License.", "Licensed under the\n\nMIT License.", "Licensed under the MIT License. v 2",
             "All\nRights reserved\nReleased under the MIT License", "Licensed\x1funder the MIT License.\x1dx", "x\x1eAll rights reserved\x1ey"]
    got = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r["sentence_ids"] for r in got] == ["", "", "", "mit-ref", "rights,mit-ref", "", "rights"]


def test_known_sentences_hold_a_trigger():
    assert all(re.search(licenses.TRIGGERS, s.lower()) for name, texts in licenses.SENTENCES.items() for s in texts if name not in ("apache2-use", "apache2-copy")) and set(
        i for _, _, sequence in licenses.RULES for i in sequence) <= set(licenses.SENTENCES)


def vectors():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(scale=0.4, size=16)).tolist()) for i in range(700)]
    rows += [(1000 + i, rows[3][1]) for i in range(300)]  # one vector many times
    return rows + [(2000, None), (2050, [0.0] * 16), (2100, [float("nan")] * 16), (2150, [None] * 16), (2200, [1.0] * 15 + [float("inf")]), (None, [1.0] * 16),
                   (2250, [1.0, 2.0]), (2251, [1.0, 2.5]), (2300, []), (2350, [1e-30] * 16), (3, rows[3][1])]


def exact_neighbours(rows, every, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, a in fine:
        if q % every == 0:
            near = [(-round(float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b)), 9), i) for i, b in fine if i != q and len(b) == len(a)]
            out[q] = sorted(near)[:k]
    return out


def test_ties_of_different_vectors_go_to_the_smaller_id(spark):
    """One-hot vectors are all at the same distance; copies of one direction are at none. Small shards and leaves."""
    size = 64
    rows = [(i, [float(j == i) for j in range(size)]) for i in range(size)]
    rows += [(100 + i, [0.0] * size + [3.0, 1.0 + i % 2]) for i in range(40)] + [(200 + i, [0.0] * size + [2.0 ** (i % 9), 0.0]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for shard_rows in (1 << 20, 20):
        got = neighbours.search(table, F.col("id") % 50 == 0, factor=1.0, shard_rows=shard_rows).collect()
        found = {}
        for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
            found.setdefault(r["query_id"], []).append(r["vec_id"])
        assert found[0] == [1, 2, 3, 4, 5] and found[50] == [0, 1, 2, 3, 4]
        assert found[100] == [102, 104, 106, 108, 110] and found[200] == [201, 202, 203, 204, 205]


def visited(data, factor):
    """Share of the pairs that are compared, and recall, of every fortieth row as a query."""
    tree, queries = neighbours.Tree(data, np.arange(len(data))), data[::40]
    true = np.argsort(-(neighbours._unit(queries) @ neighbours._unit(data).T), axis=1, kind="stable")[:, :6]
    _, where, compared = tree.search(queries, 6, factor)
    return compared / len(queries) / len(data), np.mean([len(set(a) & set(b)) / 6 for a, b in zip(true, where)])


def test_pruning_and_recall():
    """Near directions are told apart without loss; directions drawn at random, the hardest case, only by a relaxed inequality."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    near = centres[rng.integers(40, size=4000)] + rng.normal(scale=0.1, size=(4000, 16))
    share, recall = visited(near, 1.0)
    assert recall == 1.0 and share < 0.5
    apart = rng.normal(size=(8192, 64))
    assert visited(apart, 1.0)[1] == 1.0
    share, recall = visited(apart, neighbours.FACTOR)
    assert recall > 0.98 and share < 0.97


def test_neighbours_against_brute_force(spark):
    rows = vectors()
    table = spark.createDataFrame([(*r, 1.0) for r in rows], "vec_id long, embedding array<double>, score double")
    expected = exact_neighbours(rows, 50, 5)
    for shard_rows, query_rows in ((1 << 20, 1024), (150, 7)):
        got = neighbours.search(table, F.col("id") % 50 == 0, factor=1.0, shard_rows=shard_rows, query_rows=query_rows).collect()
        found = {}
        for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
            found.setdefault(r["query_id"], []).append((-round(r["score"], 9), r["vec_id"]))
        assert found == {k: v for k, v in expected.items() if v}
    loose = neighbours.search(table, F.col("id") % 50 == 0).collect()
    hits = sum((r["vec_id"] in {i for _, i in expected[r["query_id"]]}) for r in loose)
    assert hits >= 0.95 * sum(map(len, expected.values()))
    assert neighbours.search(table.limit(0), F.col("id") % 50 == 0).collect() == []


def test_large_rows_are_read_one_at_a_time(spark):
    """A row group of the stored trees holds one tree, so that Spark's reader never unpacks all trees of a file together."""
    rng = np.random.default_rng(4)
    table = spark.createDataFrame([(i, rng.integers(-9, 9, 8).astype(float).tolist()) for i in range(400)], "vec_id long, embedding array<float>")
    trees, shards = neighbours.build_index(table.coalesce(1), shard_rows=10)
    files = [pq.ParquetFile(f.removeprefix("file://")) for f in trees.inputFiles()]
    assert shards == 41 and any(f.num_row_groups > 1 for f in files)
    assert all(f.metadata.row_group(i).num_rows <= 1 for f in files for i in range(f.num_row_groups))


def test_stored_trees_hold_each_vector_once():
    rng = np.random.default_rng(4)
    single = rng.standard_normal((500, 16)).astype(np.float32).astype(np.float64)
    for data, size in ((single, 4), (single / 3, 8)):
        tree = neighbours.Tree(data, np.arange(500))
        blob = pickle.dumps(tree.state(), protocol=5)
        assert len(blob) < 500 * 16 * size + 30_000
        again = neighbours.Tree.of(pickle.loads(blob))
        assert all(np.array_equal(getattr(again, k), getattr(tree, k)) for k in ("unit", "exact", "norm", "order", "ties"))
