"""Line deduplication against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from meshfold.llm import lines


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rng, text, most, alphabet="abé"):
    out = list(text)
    for _ in range(rng.randint(0, most)):
        k, how = rng.randint(0, len(out)), rng.random()
        if how < 0.35:
            out.insert(k, rng.choice(alphabet))
        elif out and how < 0.7:
            out.pop(min(k, len(out) - 1))
        elif out:
            out[min(k, len(out) - 1)] = rng.choice(alphabet)
    return "".join(out)


def layout(texts):
    """Code points of the texts with line feeds between, their starts and lengths."""
    length = np.array([len(t) for t in texts])
    return np.frombuffer("\n".join(texts).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum(length + 1)[:-1]]), length


def brute(docs, edits, least):
    """Cleaned texts of (doc_id, text) rows."""
    docs = [(i, t or "") for i, t in docs]
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, t in docs:
        parent.update({x: x for x in t.split("\n") if len(x) >= least})
    distinct = sorted(parent, key=len)
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if len(b) - len(a) > edits:
                break
            if find(a) != find(b) and lines.within(a, b, edits):
                parent[find(a)] = find(b)
    seen, out = {}, {}
    for d in sorted({d for d in docs}, key=lambda d: (d[0] is None, d[0])):
        kept = []
        for x in d[1].split("\n"):
            if len(x) < least or find(x) not in seen:
                kept.append(x)
                if len(x) >= least:
                    seen[find(x)] = d
        out[d] = "\n".join(kept)
    return out


def test_banded_distance_is_the_plain_one():
    rng = random.Random(1)
    for _ in range(4000):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(0, 14)))
        b = edited(rng, a, 5)
        for edits in (1, 2, 3):
            assert lines.within(a, b, edits) == (distance(a, b) <= edits)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_lines_within_the_threshold_share_a_key_and_pass_the_signature(edits):
    rng, powers = random.Random(edits), lines.Powers()
    for _ in range(800):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(4 * edits + 4, 40)))
        b = edited(rng, a, edits)
        points = np.frombuffer(f"{a}\n{b}".encode("utf-32-le"), np.uint32)
        at, key = lines.line_keys(points, np.array([0, len(a) + 1]), np.array([len(a), len(b)]), edits, powers)
        assert set(key[at == 0].tolist()) & set(key[at == 1].tolist())
        facts = lines.line_facts(points, np.array([0, len(a) + 1]), np.array([len(a), len(b)]), powers)
        assert int(facts[0, 2] ^ facts[1, 2]).bit_count() <= 4 * edits
        assert lines.screened(facts[:1], facts[1:], lines.Alike(edits)).tolist() == [1]


def test_probes_are_as_many_as_the_method_says():
    for edits in range(1, 5):
        for d in range(edits + 1):
            assert sum(p[0] == d for p in lines.probes(edits)) == (edits**2 - d**2) // 2 + edits + 1


def test_chains_clusters_and_edges(spark):
    rng = random.Random(5)
    base = ["".join(rng.choice("abcdefghij klmnop") for _ in range(rng.randint(10, 60))) for _ in range(30)]
    rows = [(None, None), (0, ""), (1, "\n\n"), (2, base[0]), (2, base[0]), (None, base[0] + "\nx\nx"), (3, "é" * 20_000), (4, "é" * 19_999 + "\nshort\nshort")]
    for i in range(5, 60):
        rows.append((i, "\n".join(edited(rng, rng.choice(base), 2) for _ in range(rng.randint(1, 6)))))
    docs = spark.createDataFrame([(i, t, "z", i, 5, "w") for i, t in rows], "doc_id long, text string, line string, doc_ long, n_lines int, in_ string").repartition(4)
    got = lines.dedupe_lines(docs, 2, 8).collect()
    expected = brute(rows, 2, 8)
    assert len(got) == len(rows) and got[0].line == "z" and got[0].in_ == "w"
    assert {(r.doc_id, r.text) for r in got} == {(k[0], t) for k, t in expected.items()}
    for r in got:
        assert r.n_lines - r.n_removed == r.text.count("\n") + 1 or r.text == ""
    assert lines.dedupe_lines(docs.where("doc_id = -1")).collect() == []
    with pytest.raises(ValueError):
        lines.line_links(docs, 20, 32)


def test_a_run_over_many_tiles(spark):
    from meshfold.llm.common import components, multi_runs, run_links, tile_pairs

    members = spark.createDataFrame([(7, i) for i in range(100)] + [(8, 200), (8, 200), (9, 1), (9, 300)], "key long, id long").repartition(3)
    tiles = tile_pairs(multi_runs(members, "t", tile=8))
    links = run_links(tiles, [], lambda held, x, others: np.abs(held["id"][others] - held["id"][x]) == 10)
    found = components(links, "t").collect()
    assert {(r.node, r.component) for r in found if r.node < 100} == {(i, i % 10) for i in range(100)}
    assert not any(r.node >= 200 for r in found)


def test_query_is_brute_force(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute(rows, lines.EDITS, lines.LEAST)
    got = lines.op4_line_dedup(spark, sf_small).collect()
    assert {(r.doc_id, r.text_sha256) for r in got} == {(k[0], hashlib.sha256(t.encode()).hexdigest()) for k, t in expected.items()}
    assert sum(r.n_removed for r in got) > 0


def reworded(rng, words, most, vocabulary):
    out = list(words)
    for _ in range(most):
        k, how = rng.randrange(len(out)), rng.random()
        if how < 0.3:
            out.insert(k, rng.choice(vocabulary))
        elif how < 0.6:
            out.pop(k)
        else:
            out[k] = rng.choice(vocabulary)
    return out


@pytest.mark.parametrize("per", [20, 30])
def test_lines_within_the_share_of_words_have_a_run_in_common(per):
    rng, powers = random.Random(per), lines.Powers()
    vocabulary = ["a", "bé", "the", "𝒳y", "longer", "of"]
    for _ in range(600):
        a = [rng.choice(vocabulary) for _ in range(rng.choice([rng.randint(per - 2, 5 * per), 2 * per, 4 * per, 4 * per + 1, 300]))]
        b = reworded(rng, a, len(a) // per, vocabulary)
        most = max(len(a), len(b)) // per
        texts = ["x y", " ".join(a), "  ".join(b) + " "]
        alike, (points, start, length) = lines.Alike(2, per), layout(texts)
        at, key = lines.keys_of(points, start, length, alike, powers)
        if distance(a, b) <= most and most:
            assert set(key[at == 1].tolist()) & set(key[at == 2].tolist())
            assert lines.within(texts[1], texts[2], alike)
            facts = lines.line_facts(points, start, length, powers)
            assert sum(int(x).bit_count() for x in facts[1, 3:] ^ facts[2, 3:]) <= 2 * most
            how = lines.screened(facts[1:2], facts[2:], alike)
            assert how[0] & 2 and lines.confirmed(texts[1], texts[2], int(how[0]), alike)


def test_long_lines_with_few_edited_code_points_have_a_key_in_common():
    rng, powers, alike = random.Random(3), lines.Powers(), lines.Alike(2, 20)
    for _ in range(1500):
        words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(rng.choice([19, 20, 38, 39, 40, 41, 42, 43, 60, 78, 79, 80, 81, 82, 120]))]
        a = " ".join(words)
        b = edited(rng, a, 2, "ab  ")
        points, start, length = layout(["left out", a, b])
        at, key = lines.keys_of(points, start, length, alike, powers)
        assert set(key[at == 1].tolist()) & set(key[at == 2].tolist())
        facts = lines.line_facts(points, start, length, powers)
        assert lines.screened(facts[1], facts[2], alike) & 1


def test_facts_of_each_line_are_its_own():
    texts, powers = ["", "a", "  ", "one two  two", "é" * 300, "x\u2003y z"], lines.Powers()
    points, start, length = layout(["aa", *[t or "." for t in texts]])
    whole = lines.line_facts(points, start, length, powers)
    assert whole[:, 1].tolist() == [1, 1, 1, 0, 3, 1, 3]
    for i, t in enumerate(["aa", *[t or "." for t in texts]]):
        assert (lines.line_facts(*layout([t]), powers)[0] == whole[i]).all()


def test_each_pair_of_a_run_is_selected_once():
    rng, powers, alike = random.Random(11), lines.Powers(), lines.Alike(2, 20)
    texts = [edited(rng, rng.choice(["a plain line of text", "quite another line"]), 2) + "." for _ in range(60)]
    facts = lines.line_facts(*layout(texts), powers).view(np.int64)
    keys = np.sort(np.array([rng.randint(0, 9) for _ in texts]))
    found = [(int(a), int(b), int(h)) for block in lines._pairs(np.column_stack([keys, np.arange(60), facts]), alike) for a, b, h in zip(*block)]
    expected = [(i, j) for i in range(60) for j in range(i + 1, 60) if keys[i] == keys[j] and lines.screened(facts[i].view(np.uint64), facts[j].view(np.uint64), alike)]
    assert sorted((a, b) for a, b, _ in found) == expected and expected


@pytest.mark.parametrize("few", [2, 16])
def test_runs_of_any_length_give_the_same_classes(spark, monkeypatch, few):
    monkeypatch.setattr(lines, "FEW", few)
    monkeypatch.setattr(lines, "TILE", 16)
    monkeypatch.setattr(lines, "ROWS", 50)
    monkeypatch.setattr(lines, "BLOCK", 64)
    rng = random.Random(21)
    base = ["".join(rng.choice("abcdefghij klmnop") for _ in range(40)) for _ in range(6)]
    rows = [(i, "\n".join(edited(rng, rng.choice(base), 2) for _ in range(4))) for i in range(60)]
    got = lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 2, 8).collect()
    assert {(r.doc_id, r.text) for r in got} == {(k[0], t) for k, t in brute(rows, 2, 8).items()}


def test_the_exact_setting_takes_every_copy(spark):
    rng = random.Random(2)
    rows = [(i, "\n".join(rng.choice(["", " ", "one", "two words", "three short words", "a longer line of text that is compared by edits"]) for _ in range(5))) for i in range(12)]
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for words in (0, 1):
        seen, expected = set(), {}
        for i, t in rows:
            expected[i] = "\n".join(x for x in t.split("\n") if words and not x.strip() or not (x in seen or seen.add(x)))
        assert {r.doc_id: r.text for r in lines.dedupe_lines(given, spread=1, words=words).collect()} == expected


def test_the_stage_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "the same line of text, long enough to be compared\nb", 7, "p", 3), (2, "the same line of text, long enough to be compared\nc", 8, "q", 4)],
                                 "doc_id long, text string, n_lines int, `a.b` string, n_chars long")
    got = lines.stage(spark, docs, "").collect()
    assert {tuple(r) for r in got} == {(1, docs.first().text, 7, "p", 51), (2, "c", 8, "q", 1)}
    assert got[0].__fields__ == docs.columns


def test_long_lines_with_other_words_go(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = []
    for n in (20, 39, 41, 75, 160, 2_000):
        line = [rng.choice(words) for _ in range(n)]
        near = [w if i % 20 != 10 else "replacement" for i, w in enumerate(line)][: n]
        far = [w if i % 20 not in (3, 10, 16) else "substitute" for i, w in enumerate(line)]
        rows += [(len(rows), " ".join(line)), (len(rows) + 1, " ".join(near)), (len(rows) + 2, " ".join(far))]
    got = {r.doc_id: r.n_removed for r in lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    alike = [sum(a != b for a, b in zip(rows[i][1].split(), rows[i + 1][1].split())) <= len(rows[i][1].split()) // 20 for i in range(0, len(rows), 3)]
    assert [got[i] for i in range(1, len(rows), 3)] == [int(x) for x in alike] and sum(alike) >= 4
    assert not any(got[i] for i in range(len(rows)) if i % 3 != 1)


def test_short_lines_of_many_documents_go(spark):
    texts = [f"All rights reserved.\nYes.\n\nSeen {'twice' if i % 2 else i}\n a\u2003b" for i in range(lines.SPREAD)]
    rows = [*enumerate(texts), (50, "a b c\na b c\n" * 20), *((60 + i, "in nine") for i in range(lines.SPREAD - 1))]
    got = {r.doc_id: r.text for r in lines.dedupe_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    gone = ("All rights reserved.", " a\u2003b")
    assert got == {i: t if i in (0, 50) or i >= 60 else "\n".join(x for x in t.split("\n") if x not in gone) for i, t in rows}


@pytest.mark.parametrize("wider, tile", [(4, 2048), (4, 32), (0, 2048)])
def test_crowds_that_overlap_are_compared_as_one(spark, monkeypatch, wider, tile):
    monkeypatch.setattr(lines, "WIDER", wider)
    monkeypatch.setattr(lines, "TILE", tile)
    rng = random.Random(11)
    runs = {k: {1, *(rng.randrange(2, 60) for _ in range(40))} for k in range(100, 108)}  # of one family
    runs[200] = runs[201] = set(range(1000, 1040))  # the same lines
    runs |= {300 + k: {2000, *range(2001 + 30 * k, 2031 + 30 * k)} for k in range(8)}  # these have one line in common
    rows = [(k, i, n // lines.FEW) for k, ids in runs.items() for n, i in enumerate(sorted(ids))]
    crowds = lines._fewest_crowds(spark.createDataFrame(rows, "key long, id long, tile long"))
    tiles = [tuple(r) for r in lines.tile_pairs(crowds).select("key", "i", "j", "tile", "id").collect()]
    assert len(set(tiles)) == len(tiles)
    met = {}
    for key, i, j, t, x in tiles:
        for other, k, l, u, y in tiles:  # noqa: E741
            if x < y and (key, i, j) == (other, k, l) and (i == j or t != u):
                met[x, y] = met.get((x, y), 0) + 1
    assert {(x, y) for ids in runs.values() for x in ids for y in ids if x < y} <= set(met)
    if wider:
        family = [n for (x, y), n in met.items() if y < 2000]
        assert set(family) == {1} and len({r[0] for r in tiles}) == 10


@pytest.mark.parametrize("held, many", [(1 << 21, 4096), (40, 20), (1, 1)])
def test_keys_that_lines_share_are_found_in_buckets(monkeypatch, held, many):
    monkeypatch.setattr(lines, "PACK", 7)
    monkeypatch.setattr(lines, "SENT", 60)
    rng, few = np.random.default_rng(4), 3
    key, ids = rng.integers(0, 1 << 64, 200, np.uint64)[rng.geometric(0.03, 900) % 200], rng.integers(-50, 50, 900)
    key[:150], ids[:150] = key[0], np.arange(150)  # of very many lines
    sent = pa.Table.from_batches(lines.dealt_keys([(key[:500], ids[:500]), (key[500:], ids[500:])], 5))
    assert sent.column("bucket").to_pylist() != sorted(sent.column("bucket").to_pylist()) and set(sent.column("bucket").to_pylist()) == set(range(5))
    got = [r for batch in lines.shared_keys(sent.sort_by("bucket").to_batches(max_chunksize=4), few, held, many) for r in batch.to_pylist()]
    lines_of = {}
    for k, i in zip(key.view(np.int64).tolist(), ids.tolist()):
        lines_of.setdefault(k, set()).add(i)
    expected = {(k, i) for k, of in lines_of.items() if len(of) > 1 for i in of}
    assert {(r["key"], r["id"]) for r in got} == expected
    assert (len(got) == len(expected)) or held < 1 << 21  # of keys passed on early, a row can come twice
    for r in got:
        assert r["large"] == (len(lines_of[r["key"]]) > few) or (r["large"] and len(lines_of[r["key"]]) > many)
    assert sent.num_rows < len(key) / 3 and max(len(x) for x in sent.column("pairs").to_pylist()) <= 16 * 7


def crowd(texts):
    """A run of lines, as they are compared."""
    facts = lines.line_facts(*layout(texts), lines.Powers()).view(np.int64)
    n = np.zeros(len(texts), np.int64)
    return pa.table({"i": n, "j": n, "tile": n, "id": np.arange(len(texts)), **dict(zip(lines.FACTS, facts.T)), "line": texts})


def test_lines_that_repeat_the_same_words_are_told_apart_by_their_counts(monkeypatch):
    alike, tested, confirmed = lines.Alike(2, 20), [], lines.confirmed
    texts = [" ".join(["one two three"] * (100 - 8 * k) + ["four five"] * 12 * k) + " " * k for k in range(8)]  # of 300 words, even counts of each apart
    run = crowd([*texts, texts[3] + " six"])
    facts = lines.line_facts(*layout(texts), lines.Powers())
    assert all(lines.screened(facts[i], facts[j], alike) & 2 for i in range(8) for j in range(i))
    monkeypatch.setattr(lines, "confirmed", lambda *given: tested.append(given) or confirmed(*given))
    assert list(lines._crowd_links(run, alike)) == [(3, 8)] and len(tested) == 1


def test_counts_of_words_let_all_lines_within_the_share_through():
    rng, alike = random.Random(8), lines.Alike(2, 20)
    texts = []
    for n in (20, 39, 40, 120, 300):
        base = [rng.choice(["a", "bé", "the", "𝒳y", "of"]) for _ in range(n)]
        texts += [" ".join(reworded(rng, base, rng.randint(0, n // 12), ["a", "new", "of"])) for _ in range(60)]
    bags, others, passed = lines.Bags(texts), np.arange(len(texts)), 0
    for x in range(0, len(texts), 7):
        may = bags.may(x, others, alike)
        for y in others[~may].tolist():
            a, b = texts[x].split(), texts[y].split()
            assert not lines.within(a, b, alike.words(max(len(a), len(b))))
        passed += may.sum() - 1
    assert 0 < passed < len(texts) * len(texts) // 7 // 2
    assert not len(bags.may(0, others[:0], alike))
