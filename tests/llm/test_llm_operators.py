"""Operators against brute force, round trips and held-out accuracy, and their edge cases."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartloom.llm import chat, licenses, minhash, mixing, packing, pii, quality, shards, tables, topk, toxicity
from cartloom.llm.components import connected_components
from cartloom.llm.tables import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Extra columns have names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, txt string, n_words string, rejected int"


def docs(spark, rows, n=3):
    full = [(i, t, "en", "s", len(t or ""), 1, "x", "y", 2) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(n)


def words(r, n):
    return " ".join("".join(r.choices("abcdeé", k=r.randint(2, 6))) for _ in range(n))


EDGES = [(None, None), (None, "no id here"), (1, None), (2, ""), (3, "  \n\t"), (4, "one"), (5, "same text again"), (5, "same text again"), (6, "a " * 30_000), (7, "Ünï code\x0bgap \U0001f600 #*$")]


@pytest.fixture(scope="module")
def edges(spark):
    return docs(spark, EDGES).cache()


def test_topk_matches_brute_force(spark):
    r = np.random.default_rng(1)
    rows = [(int(i), r.normal(0, 0.2, 8).round(3).tolist()) for i in range(300)]
    rows[7] = (7, rows[50][1])  # ties
    rows += [(300, None), (301, []), (302, [1.0, None] + [0.0] * 6), (303, [float("nan")] * 8), (304, [float("inf")] * 8), (None, [0.1] * 8), (350, [0.5, 0.5]), (351, [0.25, 0.5]), (8, rows[8][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for x in topk.exact_topk(df, F.expr("vec_id % 50 = 0"), block_size=3).collect():
        got.setdefault(x.query_id, []).append((x.rank, x.vec_id, x.score))
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    want = {}
    for q, v in good:
        if q % 50 == 0:
            scored = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:5]
            want[q] = [(n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    assert {q: sorted(x) for q, x in got.items()} == want


@pytest.mark.parametrize("segments", [1, 2, 4, 9])
def test_topk_threshold_saves_products_and_no_entry(segments):
    r = np.random.default_rng(2)
    right = np.floor(256 * r.normal(0, 0.12, (400, 16)) * r.choice([0.1, 1, 3], (400, 1)))
    right[5] = 0
    left = right[::20] + np.floor(r.normal(0, 5, (20, 16)))
    own = np.arange(20)[:, None] * 20 == np.arange(400)[None, :]
    total = np.where(own, topk.NONE, left @ right.T).astype(np.int64)
    taken = []
    for place in (None, 200, 20, 5):  # a cutoff that spares nothing, then higher ones
        least = np.full(20, topk.NONE + 1) if place is None else np.sort(total, axis=1)[:, -place]
        q, row, score, products = topk.resolve(left, right, own, least, segments)
        assert sorted(zip(q, row, score, strict=True)) == [(a, b, total[a, b]) for a, b in zip(*np.nonzero(total >= least[:, None]), strict=True)]
        taken.append(products)
    assert taken[0] == 20 * 400 * 16 and taken[-1] < taken[-2] < taken[0] if segments > 1 else taken[-1] <= taken[0]
    listed = topk.listed_sums(left, right, own, segments, 10)
    assert (np.sort(listed, axis=1)[:, -5] <= np.sort(total, axis=1)[:, -5]).all()


def test_topk_columns_with_names_used_inside(spark):
    rows = [(i, [float(i % 7), 1.0], 5, "v", True) for i in range(101)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, vector string, asks boolean")
    got = topk.exact_topk(df, F.expr("vec_id % 50 = 0"))
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 15


def test_topk_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.exact_topk(empty, F.expr("vec_id % 50 = 0")).count() == 0


def plain_base(text):
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for k, (kind, p) in enumerate(patterns.items()):
        for m in re.finditer(p, text):
            d = re.sub("[^0-9]", "", m.group())
            fine = {"email": lambda d, g: True, "ip": lambda d, g: all(int(x) <= 255 for x in g.split(".")), "card": lambda d, g: 13 <= len(d) <= 19 and pii.luhn(d), "phone": lambda d, g: 9 <= len(d) <= 15}[kind]
            if fine(d, m.group()):
                out.append((k, m.start(), m.end()))
    return out


def test_base_spans_match_the_plain_patterns():
    r = random.Random(2)
    for _ in range(3000):
        text = "".join(r.choice(["1", "23", ".", "-", " ", "+", "@", "a", "b.c", "(", ")", "4111111111111111", "10.0.0.1", "x@y.z", "é"]) for _ in range(r.randint(0, 14)))
        assert pii.base_spans(text) == plain_base(text), text


@pytest.fixture(scope="module")
def tagger():
    r = random.Random(3)
    return pii.train_tagger([words(r, 60) for _ in range(50)])


def test_tagger_on_held_out_spans(tagger):
    r, found, total, wrong = random.Random(4), 0, 0, 0
    for _ in range(300):
        text, spans = words(r, 12) + " ", []
        for _ in range(r.randint(1, 2)):
            kind = r.randrange(4)
            value = pii._made_up(kind, r)
            spans.append((kind, len(text), len(text) + len(value)))
            text += value + " "
        text += words(r, 8)
        base, more = pii.find_spans([text], tagger)[0]
        total += len(spans)
        found += len(set(spans) & {*base, *more})
        wrong += len(set(more) - set(spans))
    assert found / total > 0.85 and wrong / total < 0.02


def test_tagger_finds_spellings_the_patterns_miss(tagger):
    r, found, planted, named = random.Random(9), [0] * 4, [0] * 4, 0
    for _ in range(400):
        kind, head = r.randrange(4), words(r, 8) + " "
        value = pii._spelled(kind, r)
        base, more = pii.find_spans([f"{head}{value} {words(r, 8)}"], tagger)[0]
        assert (kind, len(head), len(head) + len(value)) not in base
        planted[kind] += 1
        found[kind] += (kind, len(head), len(head) + len(value)) in more
        named += len(more)
    recall = [f / p for f, p in zip(found, planted, strict=True)]
    assert min(recall) > 0.85 and sum(found) / named > 0.97, (recall, sum(found) / named)
    wrong = [m for _ in range(600) for m in pii.find_spans([f"{words(r, 8)} {pii._no_value(r)} {words(r, 8)}"], tagger)[0][1]]
    assert len(wrong) <= 6


def test_looser_checks_hold_by_kind():
    good = [(0, "ann.lee [at] host [dot] org"), (0, "a(at)b.co"), (1, "10[.]0[.]0[.]1"), (2, "4524.1322.6465.2876"), (3, "(269) 555-3296"), (3, "0269/5553296")]
    bad = [(0, "ann at host dot org"), (0, "a[at]b.7"), (1, "10[.]0[.]0[.]256"), (2, "4524.1322.6465.2877"), (3, "1990 1991 1992"), (3, "(269 555-3296"), (3, "555-3296")]
    assert all(pii.loosely_valid(k, v) for k, v in good) and not any(pii.loosely_valid(k, v) for k, v in bad)


def test_personal_data_of_an_empty_table_and_a_very_long_text(spark):
    assert pii.find_personal_data(docs(spark, [])).collect() == []
    text = "word " * 60_000 + "mail ann@host.org or call (269) 555-3296 now"
    (row,) = pii.find_personal_data(docs(spark, [(1, text)])).collect()
    at, call = text.index("ann@"), text.index("(269)")
    assert row["spans"] == f"email:{at}:{at + 12},phone:{call}:{call + 14}"


def test_tagger_parts_what_a_pattern_swallows(tagger):
    text = "call +1 (269) 555-3296 4524132264652876 today"
    base, more = pii.find_spans([text], tagger)[0]
    assert not base
    assert [text[a:b] for _, a, b in more] == ["4524132264652876", "+1 (269) 555-3296"]


def test_windows_cover_and_spans_reconcile():
    text = "x" * 500 + "1" + "y" * 30 + "2@" + "z" * 400
    covered = {i for s in pii.windows_of(text, 96, 40) for i in range(s, s + 96)}
    assert set(range(460, 574)) <= covered and len(covered) < 400
    assert pii.reconcile([(0, 0, 5, 3.0), (1, 4, 9, 4.0), (2, 8, 12, 3.0), (2, 8, 12, 2.0), (3, 20, 22, -1.0)]) == [(0, 0, 5), (2, 8, 12)]


def test_personal_data_edges(edges):
    rows = pii.find_personal_data(edges, with_rows=True).collect()
    assert len(rows) == len(EDGES) and {r["spans"] for r in rows} == {""}


def test_quality_counts(spark, edges):
    r = random.Random(5)
    rows = [(i, "\n".join(r.choice(["aa bb cc dd ee ff", "the of #1 |x|", "", " \t", words(r, 9)]) for _ in range(r.randint(1, 9)))) for i in range(200)]
    for df, given in ((docs(spark, rows), rows), (edges, EDGES)):
        got = Counter(tuple(x)[:8] for x in quality.judge_quality(df).collect())
        want = Counter()
        for i, text in given:
            t = text or ""
            w = WORD.findall(t)
            counts = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
            repeated = {j for k in range(len(w) - 4) if counts[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
            lines = [x for x in t.split("\n") if WORD.search(x)]
            failed = len(w) < 10 or 100 * len(repeated) > 20 * len(w)
            chars, symbols, same = sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines))
            stops = sum(x.lower() in quality.STOP_WORDS for x in w)
            kept = not failed and 2 <= chars / len(w) <= 16 and symbols / len(w) <= 0.1 and same / len(lines) <= 0.5 and stops / len(w) >= 0.02
            want[(i, len(w), chars, symbols, same, len(repeated), failed, kept)] += 1
        assert got == want


def test_the_positional_filter_drops_candidates_and_no_find(spark):
    """A block whose words from the first shared one on are too few is no candidate, whatever it holds before."""
    templates = [licenses.Template("a", tuple(f"a{i}" for i in range(30)), 24, 40), licenses.Template("b", tuple(f"b{i}" for i in range(30)), 24, 40)]
    count = {f"a{i}": i for i in range(30)} | {f"b{i}": 100 + i for i in range(30)}
    bodies = {1: [f"a{i}" for i in range(23)] + [f"b{i}" for i in range(4)], 2: [f"b{i}" for i in range(24)], 3: [f"a{i}" for i in range(5, 30)] + ["b1"]}
    rows = [(k, 0, 0, " ".join(w), len(w), sorted(w, key=lambda x: (count[x], x))) for k, w in bodies.items()]
    hits = spark.createDataFrame(rows, "id long, key long, block int, body string, size int, hits array<string>")
    found = {(r.id, r.label): r.containment for r in licenses.similar_blocks(hits, templates, count).collect()}
    assert found == {(2, "b"): 24 / 30, (3, "a"): 25 / 30}
    # Block 1 holds 27 words, enough by length, but only 4 from the first word of b on.
    assert len(bodies[1]) >= 24 and "array_position" in licenses.similar_blocks(hits, templates, count)._jdf.queryExecution().optimizedPlan().toString()


def test_license_phrases_and_blocks(spark, edges):
    separators = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    notice = licenses.TEMPLATES["mit"].replace("hereby", "HEREBY")
    rows = [(1, "Mit License, MIT LICENSE cc-by"), (2, "x\n" + notice + "\ny"), (3, "gnu general\npublic license"), (4, "cc byte"), (5, "Under CC BY-NC 4.0."), (6, "of the Software and to copy")]
    # Characters beyond U+FFFF are words of one code point each.
    rows += [(7, "\U0001f600 " * 12 + "mit license x"), (8, "\U0001f600 " * 30 + "see the apache license, \U0001f600 Mit License \U0001f600")]
    for df, given in ((docs(spark, rows), rows), (edges, EDGES)):
        for x in licenses.scan_licenses(df).collect():
            text = next(t for i, t in given if i == x.doc_id and (i is not None or True) and len(separators.findall((t or "").translate(LOW))) == x.n_words)
            w = separators.findall((text or "").translate(LOW))
            places = sorted((k, label) for k in range(len(w)) for p, label in licenses.PHRASES.items() if w[k : k + len(p.split())] == p.split())
            assert x.n_base == len(places) and x.base_labels == ",".join(sorted({p[1] for p in places}))
            assert (x.first_word, x.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
            best = {}
            for line in (text or "").translate(LOW).split("\n"):
                block = set(separators.findall(line))
                for label, template in licenses.TEMPLATES.items():
                    t = licenses.Template.of(label, template, 0.8)
                    if len(block & set(t.words)) >= t.need:
                        best[label] = max(best.get(label, 0), len(block & set(t.words)) / len(t.words))
            assert x.labels == ",".join(sorted({*best, *(p[1] for p in places)}))
            assert x.score == (1.0 if places else pytest.approx(max(best.values(), default=0)))


def test_license_notices_wrapped_over_lines(spark):
    r, rows = random.Random(14), []
    for k, (label, notice) in enumerate(licenses.TEMPLATES.items()):
        wrapped = textwrap.fill(notice, 72, initial_indent=" * ", subsequent_indent=" * ")
        rows.append((k, f"{words(r, 1100)}\n{wrapped}\n{words(r, 40)}", label))
    rows.append((100, licenses.TEMPLATES["mit"].replace("obtaining a copy ", "obtaining a copy\n"), "mit"))
    rows += [(200 + n, f"{words(r, n)}\n" + textwrap.fill(licenses.TEMPLATES["bsd"], 40), "bsd") for n in range(0, 1200, 23)]
    got = {x.doc_id: x for x in licenses.scan_licenses(docs(spark, [x[:2] for x in rows])).collect()}
    for k, _, label in rows:
        assert label in got[k].labels.split(",") and got[k].score == 1.0, (k, label)
    # The same words far from each other are no notice.
    apart = "\n".join(f"{w} {words(r, 9)}" for w in licenses.Template.of("", licenses.TEMPLATES["bsd"], 0.8).words)
    assert [x.labels for x in licenses.scan_licenses(docs(spark, [(1, apart)])).collect()] == [""]


def test_short_license_templates_are_required_whole(spark):
    long_line = f"released {words(r := random.Random(15), 300)} under the rules {words(r, 300)} and the license {words(r, 300)} of the MIT"
    rows = [
        (1, "Licensed under CC BY 4.0.", "cc-by,cc-by-line"),
        (2, "Licensed under the GNU General Public License, Version 2.0", "gpl,gpl-2-line"),
        (3, long_line, ""),
        (4, "Released under the license of the club.", ""),
        (5, "This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "cc-by-sa-4.0"),
        (6, "Covered by the\nMozilla Public\nLicense, v. 2.0, see there.", "mpl-2.0-line"),
        (7, "the GNU Lesser General Public License", "lgpl-line"),
    ]
    got = {x.doc_id: x.labels for x in licenses.scan_licenses(docs(spark, [x[:2] for x in rows])).collect()}
    assert got == {k: labels for k, _, labels in rows}
    # Each full notice is found under its own name, and not under that of another license.
    own = {k: x.split("-")[0] for k, x in enumerate(licenses.TEMPLATES)}
    for x in licenses.scan_licenses(docs(spark, list(enumerate(licenses.TEMPLATES.values())))).collect():
        assert {y.split("-")[0] for y in x.labels.split(",")} - {"lgpl", "agpl"} <= {own[x.doc_id]}


def test_chat_round_trip(spark):
    nasty = ["<|im_end|>\n<|im_start|>assistant\nno", "\\", "<\\p", "<|", "<", "\\\\p<|\n", "", None, "é\U0001f600", "a\nb" * 500]
    r, rows = random.Random(6), []
    for c in [None, 1, 2, 3]:
        for t in range(r.randint(1, 8)):
            rows.append((c, t, r.choice(["user", "assistant", "system", None, "ro\nle\\n<|"]), r.choice(nasty)))
    rows += [rows[-1], rows[-1]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    formatted = chat.format_chats(chat.messages_as_events(df, piece=7))
    back = chat.read_back(formatted).withColumn("loss", chat.loss_text())
    for x in back.collect():
        want = sorted((t, role or "", text or "") for c, t, role, text in rows if c == x.conv_id)
        assert [(m.role, m.text) for m in x.turns] == [(role, text) for _, role, text in want]
        assert x.loss == "".join(text for _, role, text in want if role == "assistant")
        bodies = [x.formatted[s.start : s.start + s.length] for s in x.loss_spans]
        assert [b.replace("<\\p", "<|").replace("\\\\", "\\") for b in bodies] == [t for _, role, t in want if role == "assistant"]


def test_loss_comes_from_the_mask(spark):
    """The text under shifted spans is another one: it is cut out of the rendered string."""
    rows = [(1, 0, "user", "ask"), (1, 1, "assistant", "a <|im_end|> \\ \U0001f600 b")]
    formatted = chat.format_chats(chat.messages_as_events(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    assert formatted.select(chat.loss_text()).first()[0] == rows[1][3]
    moved = formatted.withColumn("loss_spans", F.expr("transform(loss_spans, s -> struct(s.start as start, 3L as length))"))
    assert moved.select(chat.loss_text()).first()[0] == "a <"


def test_chat_of_no_events(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(chat.messages_as_events(empty)).count() == 0


def test_shards(spark, edges):
    r = random.Random(7)
    rows = [(i, "copy " * 40 if i % 3 == 0 else words(r, r.randint(1, 200))) for i in range(3000)] + [(9, "twin")] * 1500
    for df, given in ((docs(spark, rows), rows), (edges, EDGES)):
        got = shards.shard_by_bytes(df).collect()
        want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in given)
        assert Counter((x.doc_id, x["size"], x.text_crc32) for x in got) == want
        slots = {}
        for x in got:
            slots.setdefault(x.shard, []).append(x.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    per = Counter()
    for x in shards.shard_by_bytes(docs(spark, rows)).collect():
        per[x.shard] += x["size"]
    assert len(per) == 40 and max(per.values()) - min(per.values()) < 4000
    assert shards.shard_by_bytes(docs(spark, rows).limit(0)).count() == 0


def classes_by_force(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]


def test_near_duplicates_match_brute_force(spark):
    r, rows = random.Random(8), []
    for g in range(30):
        base = words(r, r.randint(6, 120)).split()
        for _ in range(r.choice([1, 2, 3, 40])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                own[r.randrange(len(own))] = words(r, 1)
            rows.append((len(rows), " ".join(own).upper() if r.random() < 0.2 else "  ".join(own)))
    rows += [(len(rows) + k, t) for k, (_, t) in enumerate(EDGES)]
    for kw in ({}, {"chunk_sets": 8}):
        got = minhash.near_duplicates(docs(spark, rows), **kw).collect()
        assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(classes_by_force(rows))
        assert all(x.kept == (x.doc_id == x.component_id) for x in got)


def test_near_duplicate_edges(spark, edges):
    key = lambda x: (x[0] is not None, x)
    got = [(x.doc_id, x.n_shingles, x.component_id) for x in minhash.near_duplicates(edges).collect()]
    assert sorted(map(str, got)) == sorted(map(str, classes_by_force(EDGES)))
    assert minhash.near_duplicates(edges.limit(0)).count() == 0
    del key


def test_near_duplicates_with_hot_classes_and_one_large_component(spark):
    r = random.Random(15)
    base = words(r, 60)
    near = [base + " " + words(r, 3) for _ in range(300)]
    rows = [(i, base if i % 3 == 0 else ("" if i % 7 else None) if i % 3 == 1 else near[i % 300]) for i in range(1500)]
    rows += [(1500 + i, words(r, 30)) for i in range(50)]
    got = minhash.near_duplicates(docs(spark, rows), chunk_sets=40).collect()
    assert sorted((x.doc_id, x.n_shingles, x.component_id) for x in got) == sorted(classes_by_force(rows))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(300)] + [(1000, i) for i in range(1001, 1200)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    df = spark.createDataFrame(edges, "a long, b long")
    roots = {x.node: x.root for x in connected_components(df, Scratch(spark, "test")).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and len({roots[i] for i in range(1000, 1200)}) == 1
    assert len(set(roots.values())) == 3 and 5000 not in roots


def test_toxicity_held_out(spark):
    r = random.Random(9)
    bad = ["foulword", "nastything", "vileness"]

    def text(toxic):
        w = words(r, r.randint(20, 60)).split()
        for _ in range(toxic):
            w.insert(r.randrange(len(w)), r.choice(bad) + r.choice(["", "ly", "er"]))
        return " ".join(w)

    grades = [r.choice([0, 0, 0, 1, 2, 5]) for _ in range(900)]
    df = docs(spark, [(i, text(g)) for i, g in enumerate(grades)])
    labels = spark.createDataFrame([(i, 1, int(g > 0)) for i, g in enumerate(grades[:600])] + [(5000, 1, 1), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.grade_toxicity(df, labels).collect()}
    right = sum(got[i].rejected == (grades[i] > 0) for i in range(600, 900))
    assert right >= 290
    mean = lambda g: np.mean([got[i].severity for i in range(600, 900) if grades[i] == g])
    assert mean(0) < mean(1) < mean(5)


def test_toxicity_edges(spark, edges):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.grade_toxicity(edges, none, with_rows=True).select("row.*", "severity").collect()
    assert len(rows) == len(EDGES) and all(x.severity == 0 for x in rows)


def test_mixing_meets_targets(spark, edges):
    r, rows = random.Random(10), []
    for i in range(600):
        w = words(r, 60)
        rows.append((i, w.upper().replace(" ", "!! ") if i % 4 == 0 else w))
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(300)], "doc_id long, quality int, toxic int")
    targets = mixing.Targets(weights={"en": 0.9, "en-junk": 0.1}, budget=40_000)
    got = mixing.mix_sources(docs(spark, rows), labels, targets).collect()
    tokens = {d: sum(x.n_tokens * x.rate for x in got if x.domain == d) for d in ("en", "en-junk")}
    assert tokens["en"] == pytest.approx(36_000, rel=0.02) and tokens["en-junk"] == pytest.approx(4_000, rel=0.05)
    assert all((x.domain == "en-junk") == (x.doc_id % 4 == 0) for x in got)
    capped = mixing.mix_sources(docs(spark, rows), labels, targets, most=1.0, with_rows=True).collect()
    assert all(x.rate <= 1 and x.copies <= 1 for x in capped) and len(capped) == 600
    none = mixing.mix_sources(edges, labels.limit(0), targets).collect()
    assert len(none) == len(EDGES)


def dense_rates(tokens, p, wanted, most, rounds=200_000):
    """Plain projected gradient over all cells, with the same pull to rate 1."""
    present = np.maximum(tokens @ p, 1)
    rate = np.ones(len(tokens))
    for _ in range(rounds):
        miss = (tokens * rate) @ p - wanted
        rate = np.clip(rate - 0.9 * (p @ (miss / present) + mixing.PULL * (rate - 1)), 0, most or np.inf)
    return rate


@pytest.mark.parametrize("most", [None, 1.0, 2.5])
def test_fitted_rates_equal_dense_projected_gradient(spark, most):
    generator = np.random.default_rng(3)
    tokens, p = generator.integers(1, 4000, 30), generator.dirichlet([0.15, 0.1, 0.2], 30)
    wanted = np.array([0.5, 1.3, 0.8]) * (tokens @ p)
    cells = spark.createDataFrame([(str(i), int(t), [float(x) for x in row]) for i, (t, row) in enumerate(zip(tokens, p))], "bins string, tokens long, p array<double>")
    targets = mixing.Targets(factors=dict(zip("abc", (0.5, 1.3, 0.8))))
    fitted, miss = mixing.fit_rates(cells, list("abc"), targets, most, 40)
    got = np.array([r.rate for r in fitted.orderBy(F.expr("cast(bins as int)")).collect()])
    want = dense_rates(tokens.astype(float), p, wanted, most)

    def loss(rate):
        return (((tokens * rate) @ p - wanted) ** 2 / (2 * (tokens @ p))).sum() + mixing.PULL / 2 * (tokens * (rate - 1) ** 2).sum()

    assert loss(got) <= loss(want) * (1 + 1e-3) + 1e-9
    assert np.allclose([miss[d] for d in "abc"], ((tokens * got) @ p - wanted) / wanted, atol=1e-9)
    if most is None:
        assert max(abs(x) for x in miss.values()) < 1e-3


def test_targets_by_text_are_reached(spark):
    cells = spark.createDataFrame([("0", 900, [0.98, 0.02]), ("1", 100, [0.1, 0.9]), ("2", 50, [0.45, 0.55])], "bins string, tokens long, p array<double>")
    fitted, miss = mixing.fit_rates(cells, ["a", "junk"], mixing.Targets(factors={"junk": 0.25}, by_text=True), 1.0, 40)
    assert max(abs(x) for x in miss.values()) < 1e-3
    assert fitted.where("bins = '0'").first().rate > 0.99


def test_mixing_with_clashing_names(spark):
    rows = [(i, "word " * 30, "en", 1, 2, "b") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, quality int, id int, bins string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = mixing.mix_sources(df, labels, mixing.Targets(), domain="concat(lang, bins, id, quality)").collect()
    assert len(got) == 40 and {r.domain for r in got} <= {"enb20", "enb21"}
    assert mixing.mix_sources(df.limit(0), labels, mixing.Targets()).count() == 0


def test_mixing_meets_the_targets_of_small_domains(spark):
    r, rows = random.Random(16), []
    looks = {"en": str, "de": lambda w: w.replace("a", "ß"), "fr": lambda w: w.replace("a", "è"), "es": lambda w: w.upper().replace(" ", "!! ")}
    for i in range(2004):
        lang = "en" if i % 100 > 2 else ["de", "fr", "es"][i % 100]
        rows.append((i, looks[lang](words(r, 60)), lang, "s", 1, 1, "x", "y", 2))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2004)], "doc_id long, quality int, toxic int")
    targets = mixing.Targets(weights={"en": 0.5, "de": 0.25, "fr": 0.25}, budget=100_000)
    got = mixing.mix_sources(df, labels, targets).collect()
    tokens, present = Counter(), Counter()
    for x in got:
        tokens[x.domain] += x.n_tokens * x.rate
        present[x.domain] += x.n_tokens
    assert {d: tokens[d] for d in ("en", "de", "fr")} == pytest.approx({"en": 50_000, "de": 25_000, "fr": 25_000}, rel=0.02)
    assert tokens["es"] == pytest.approx(present["es"], rel=0.01) and max(abs(x.miss) for x in got) <= 1e-3
    capped = {x.domain: x.miss for x in mixing.mix_sources(df, labels, targets, most=1.0).collect()}
    assert capped["de"] < -0.5 and abs(capped["en"]) <= 0.01


def test_packing_round_trip(spark, edges):
    r = random.Random(11)
    rows = [(i, words(r, r.choice([3, 50, 900, 4000]))) for i in range(60)]
    tokenizer = packing.WordTokenizer(None)
    for df, given in ((docs(spark, rows), rows), (edges, [x for x in EDGES if x[0] != 5])):
        pieces = packing.pack_documents(df).collect()
        by_doc, by_seq = {}, {}
        for p in pieces:
            by_doc.setdefault(p.doc_id, []).append(p)
            by_seq.setdefault(p.sequence_id, []).append(p)
        for s in by_seq.values():
            at = 0
            for p in sorted(s, key=lambda p: p.offset):
                assert p.offset == at
                at += p.length
            assert at == 2048 or at & (at - 1) == 0
        for i, text in given:
            if i is None:
                continue
            ids = np.array(tokenizer.model.encode(text or "", add_special_tokens=False).ids + [1], "<u4").tobytes()
            own, at = sorted(by_doc[i], key=lambda p: p.start), 0
            for p in own:
                assert p.start == at and p.doc_tokens == len(ids) // 4
                assert p.ids_crc32 == zlib.crc32(ids[4 * p.start : 4 * (p.start + p.length)])
                at += p.length
            assert at == len(ids) // 4


def test_a_loss_limit_binds_with_little_padding():
    r, limits = random.Random(14), packing.Limits(256, 16, 224)
    packer, sizes = packing.Packer(limits, open_bins=8), [r.choice([r.randint(1, 60), r.randint(60, 400), 5000]) for _ in range(600)]
    for i, n in enumerate(sizes):
        packer.add(packing.Piece(i, 0, memoryview(bytes(4 * n)), n, n // 4))
    packer.finish()
    seen = {i: [] for i in range(600)}
    for s in packer.closed:
        assert sum(p.length for p in s) <= 256 and len(s) <= 16 and sum(p.loss for p in s) <= 224
        for p in s:
            seen[p.doc_id].append((p.start, p.length))
    for i, n in enumerate(sizes):  # each id in one piece
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at and length > 0
            at += length
        assert at == n
    assert sum(sum(p.loss for p in s) == 224 for s in packer.closed) > len(packer.closed) / 10
    full = [sum(p.length for p in s) for s in packer.closed]
    padded = sum(256 - n for n in full if n & (n - 1))
    assert padded < 0.005 * sum(sizes)


def test_packer_keeps_all_limits():
    r = random.Random(12)
    limits = packing.Limits(100, 4, 60)
    packer, total = packing.Packer(limits, open_bins=5), 0
    for i in range(500):
        n = r.randint(1, 250)
        total += n
        packer.add(packing.Piece(i, 0, memoryview(bytes(4 * n)), n, n // 2))
    packer.finish()
    for s in packer.closed:
        assert sum(p.length for p in s) <= 100 and len(s) <= 4 and sum(p.loss for p in s) <= 60
    assert sum(p.length for s in packer.closed for p in s) == total


def test_cached_word_ids_equal_the_tokenizers():
    r, t = random.Random(13), packing.WordTokenizer(None, most=50)
    alphabet = ["a", "B", "é", "ß", " ", "\n", "'s", "1", "²", ".", "!!", "\x1c", "日本", "İ", "Σ", "<|endoftext|>", "́", " ", "\U0001f600", "д"]
    for _ in range(500):
        text = "".join(r.choices(alphabet, k=r.randint(0, 30)))
        assert t.encode(text) == t._whole(text), text


def test_hashes_are_stable():
    assert hashlib.sha256(minhash.Sketch(5, 30, 4, 7).factors.tobytes()).hexdigest() == hashlib.sha256(minhash.Sketch(5, 30, 4, 7).factors.tobytes()).hexdigest()


def test_workers_give_freed_memory_back_after_each_task(monkeypatch):
    events = []
    monkeypatch.setattr(tables, "release_memory", lambda: events.append("released"))

    def task(batches):
        for b in batches:
            events.append(b)
            yield b

    assert list(tables.returning_memory(task)(iter([1, 2]))) == [1, 2]
    assert events == [1, 2, "released"]

    def fails(batches):
        raise ValueError
        yield

    with pytest.raises(ValueError):
        list(tables.returning_memory(fails)(iter([])))
    assert events[-1] == "released" and len(events) == 4
    monkeypatch.undo()
    tables.release_memory()


@pytest.mark.parametrize("stage", ["toxicity", "minhash", "pii", "packing"])
def test_stages_of_the_pipeline_return_memory(spark, monkeypatch, stage):
    module, wrapped = {"toxicity": toxicity, "minhash": minhash, "pii": pii, "packing": packing}[stage], []
    monkeypatch.setattr(module, "returning_memory", lambda task: wrapped.append(task) or tables.returning_memory(task))
    docs = spark.createDataFrame([(i, f"some words of text number {i}") for i in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, float(i % 2)) for i in range(20)], "doc_id long, toxic double")
    run = {
        "toxicity": lambda: toxicity.grade_toxicity(docs, labels),
        "minhash": lambda: minhash.near_duplicates(docs),
        "pii": lambda: pii.find_personal_data(docs),
        "packing": lambda: packing.pack_documents(docs),
    }[stage]
    assert run().count() >= 1 and wrapped


def test_word_tokenizer_keeps_one_vocabulary_and_writes_new_words_at_once():
    t = packing.WordTokenizer(None)
    assert t.cut_words.get_vocab_size(with_added_tokens=True) == t.model.get_vocab_size(with_added_tokens=False)
    assert t._written(["ab", "c.d"]) == "ab c.d"
    assert t._written(["é", "\x00"]) == "Ã© Ā"
    for text in ("Don't I'LL 'S 1's \x1c'tx\x7f", "ab\tcd\x0bef", "é\xa0ß 's’s", "\x00\x1f 'S", " \n", ""):
        assert t.encode(text) == t._whole(text)
        assert t.encode(text) == t._whole(text)  # with all words known


ODD_TEXTS = [
    "Don't stop, I'LL go. 'S 1's ab12 #tag| x", "", "  \t ", " two  runs\n", "ab\x1ccd\x1f \x00 'tx\x7f", "é\xa0ß\x85'sñ 12²", "ñandú, ÜBER's",
    "Привет, мир! 東京 ひらがな 한국 12", "İstanbul ς", "a <|endoftext|> b", "\x85", "é x", "same same, same", " wide gap",
]


def test_word_tokenizer_encodes_the_texts_of_a_group_in_one_call():
    t, calls = packing.WordTokenizer(None), []
    wanted = [t._whole(x) for x in ODD_TEXTS]

    class Counted:
        def encode_batch_fast(self, texts, **options):
            calls.append(texts)
            return cut_words.encode_batch_fast(texts, **options)

    cut_words, t.cut_words = t.cut_words, Counted()
    assert t.encode_all(ODD_TEXTS) == wanted and len(calls) == 1
    assert t.encode_all(ODD_TEXTS[::-1]) == wanted[::-1] and len(calls) == 1
    assert t.encode_all([]) == [] and t.encode_all(["", "İ"]) == [b"", t._whole("İ")]
    t.most = 3
    assert [t.encode_all([x])[0] for x in ODD_TEXTS * 2] == wanted * 2
    assert len(t.young) <= 40
    t.young, t.old, t.ends = {}, {}, np.zeros_like(t.ends)  # as if the vocabulary cut words in another way
    assert t.encode_all(ODD_TEXTS) == wanted


@pytest.mark.parametrize("together", [1, 30, 10_000])
def test_groups_of_texts_keep_their_order(monkeypatch, together):
    import pyarrow as pa

    t, sizes = packing.WordTokenizer(None), []
    encode_all = t.encode_all
    monkeypatch.setattr(packing, "TOGETHER", together)
    monkeypatch.setattr(t, "encode_all", lambda texts: sizes.append(sum(map(len, texts))) or encode_all(texts))
    assert list(packing._encoded(t, pa.array(ODD_TEXTS))) == [t._whole(x) for x in ODD_TEXTS]
    assert all(s <= max(together, max(map(len, ODD_TEXTS))) for s in sizes)
    assert list(packing._encoded(t, pa.array([], pa.string()))) == []
