"""Copies, near copies, scan repair, tokens, packing, abuse."""

import itertools
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from paperloom.llm import abuse, boosting, copies, lexicon, nearcopies, packing, queries, scan_repair, tokenise

DATA = "/root/testdata/sf0.001"
QS = "u long, t string, o array<string>, k string, first long"


def words(s):
    return re.findall(r"[^\W_]+", s.lower())


def norm(t, o):
    return "".join(words(t)), tuple(sorted(x for x in ("".join(words(x)) for x in o or [] if x) if x))


def records(n=120, seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    out, u = [], 0
    for _ in range(n):
        t, o = [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 14))], [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 4))]
        for _ in range(rnd.choice([1, 1, 2, 4])):
            u += 1
            t2, o2 = list(t), list(o)
            if t2 and rnd.random() < 0.5:
                t2[rnd.randrange(len(t2))] = rnd.choice(vocabulary)
            rnd.shuffle(o2)
            text = rnd.choice([" ", "  ", ", "]).join(t2)
            out.append((u, rnd.choice([str.upper, str.title, str])(text) + rnd.choice(["", ".", " !"]), rnd.choice([o2, [x.upper() for x in o2], [*o2, None], o2 or None]), "clash", 0))
    return out + [(u + 1, None, ["a"], "", 0), (u + 2, " .. ", None, "", 0), (u + 3, "x" * 50_000, [], "", 0), (u + 4, "X" * 50_000, None, "", 0)]


def test_copies(spark):
    rows = records()
    got = {r.u: (r.first, r.n) for r in copies.copy_classes(spark.createDataFrame(rows, QS).repartition(3), "u", "t", "o").collect()}
    classes = {}
    for u, t, o, *_ in rows:
        if t and words(t):
            classes.setdefault(norm(t, o), []).append(u)
    want = {u: (min(c), len(c)) for c in classes.values() if len(c) > 1 for u in c}
    assert got == want and want
    assert copies.copy_classes(spark.createDataFrame([], QS), "u", "t", "o").count() == 0


def elements(t, o):
    w = words(t)
    return {("t", *w[i : i + 3]) for i in range(len(w) - 2)} | {("o", " ".join(words(x))) for x in o or [] if x and words(x)}


def test_near_copies(spark):
    rows = records(150, 2)
    live = [(u, norm(t, o), elements(t, o)) for u, t, o, *_ in rows if t and words(t)]
    want = {(a[0], b[0]) for a, b in itertools.combinations(live, 2) if a[1] != b[1] and a[2] | b[2] and len(a[2] & b[2]) >= 0.5 * len(a[2] | b[2])}
    df = spark.createDataFrame(rows, QS)
    cut = lambda x: nearcopies.question_elements(x, "u", "t", "o", width=3)
    got = [tuple(r) for r in nearcopies.similar_pairs(df, cut, 0.5, miss=1e-9).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    groups = {r.u: (r.group_uid, r.n_records) for r in nearcopies.similar_groups(df, cut, 0.5, miss=1e-9, key="u").collect()}
    root = {u: u for pair in want for u in pair}
    for _ in root:
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    size = Counter(root.values())
    assert groups == {u: (r, size[r]) for u, r in root.items()}
    assert nearcopies.similar_pairs(df.limit(0), cut).count() == 0 and nearcopies.similar_groups(df.limit(0), cut).count() == 0


def test_near_copies_hot_band(spark, monkeypatch):
    """A family larger than a block: every pair, each once."""
    monkeypatch.setattr(nearcopies, "HOT", 7)
    common = " ".join(f"c{i}" for i in range(40))
    rows = [(u, f"{common} tail{u}", ["a"], "", 0) for u in range(40)]
    df = spark.createDataFrame(rows, QS)
    got = [tuple(r) for r in nearcopies.similar_pairs(df, lambda x: nearcopies.question_elements(x, "u", "t", "o", width=3), 0.5).collect()]
    assert len(got) == len(set(got)) and set(got) == set(itertools.combinations(range(40), 2))


def test_near_copies_recall(spark):
    """The shipped setting against all pairs of sf0.01 that reach 0.5."""
    q = spark.read.parquet("/root/testdata/sf0.01/questions.parquet")
    got = {tuple(r) for r in queries.p4_found(spark, "/root/testdata/sf0.01").collect()}
    rows = [(r.question_uid, norm(r.question_text, r.options), elements(r.question_text, r.options)) for r in q.select("question_uid", "question_text", "options").collect() if r.question_text and words(r.question_text)]
    by = {}
    for i, (_, _, e) in enumerate(rows):
        for x in e:
            by.setdefault(x, []).append(i)
    common = Counter(p for m in by.values() for p in itertools.combinations(m, 2))
    want = {tuple(sorted((rows[i][0], rows[j][0]))) for (i, j), c in common.items() if rows[i][1] != rows[j][1] and c >= 0.5 * (len(rows[i][2]) + len(rows[j][2]) - c)}
    assert got <= want and len(got) >= 0.999 * len(want) and want


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(0, 300)] + [(1000 + rnd.randrange(80), 1000 + rnd.randrange(80)) for _ in range(60)] + [(5000, 4000 + i) for i in range(50)]
    got = {r.k: r.root for r in nearcopies.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {u: u for p in links if p[0] != p[1] for u in p}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if a != b and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    assert got == root


def test_sketch():
    rnd = np.random.default_rng(0)
    shared, a, b = (rnd.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64) for n in (300, 100, 100))
    s = nearcopies.sketches(np.concatenate([shared, a, shared, b, shared[:1]]), np.array([400, 400, 1]), 512)
    assert (s != np.uint32(0xFFFFFFFF)).all()
    assert abs((s[0] == s[1]).mean() - 0.6) < 0.08
    assert nearcopies.plan_bands(0.5, 4, 0.02) == 61


@pytest.fixture(scope="module")
def encoder():
    return tokenise.Encoder(tokenise.serialise_model(tokenise.read_ranks(tokenise.DEFAULT_VOCABULARY)))


def test_tokens(spark, encoder):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(tokenise.DEFAULT_VOCABULARY, "rb"))}
    other = tiktoken.Encoding("own", pat_str=tokenise.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = [r[0] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("text").collect() if r[0]]
    texts += ["<|endoftext|> <unk>", "\x00\x01 a", "▁ ▁", "🙂🙃é", "a" * 5000, " " * 300, "\r\n\t x"]
    for t in texts:
        ids = encoder.encode(t)
        assert ids == other.encode_ordinary(t) and encoder.decode(ids) == t
    df = spark.createDataFrame([(1, None, 5), (2, "", 6), (3, "a b", 7), (3, "a b", 7)], "doc_id long, text string, ids int")
    assert sorted((r.doc_id, r.ids) for r in tokenise.encode_texts(df, "doc_id", "text").collect()) == [(1, []), (2, []), (3, [64, 275]), (3, [64, 275])]


@pytest.mark.parametrize("open_bins", [1, 3, 64])
def test_best_fit(open_bins):
    rnd = random.Random(5)
    fit, load = packing.BestFit(100, open_bins), Counter()
    for _ in range(3000):
        size = rnd.choice([1, 7, 33, 50, 99, 100, rnd.randint(1, 100)])
        b, offset = fit.place(size)
        assert load[b] == offset and offset + size <= 100
        load[b] += size
        assert fit.n_open <= open_bins
    assert sum(load.values()) / (100 * len(load)) > {1: 0.55, 3: 0.7, 64: 0.95}[open_bins]


def test_packing(spark, encoder):
    texts = [None, "", " ", "a b c", "word " * 5000, "a b c"] + ["x y z " * k for k in range(1, 400)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, bin_id int").repartition(5)
    rows = packing.pack_texts(df, "doc_id", "text", 512, 8).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    bins = {}
    for i, t in enumerate(texts):
        n = len(encoder.encode(t))
        parts = sorted(by[i], key=lambda r: r.piece)
        assert [p.start_token for p in parts] == list(range(0, max(n, 1), 512)) and sum(p.n_tokens for p in parts) == n
        assert all((p.bin_id is None) == (p.n_tokens == 0) for p in parts)
        for p in parts:
            if p.n_tokens:
                bins.setdefault(p.bin_id, []).append((p.bin_offset, p.n_tokens))
    for spans in bins.values():
        end = 0
        for offset, n in sorted(spans):
            assert offset == end
            end += n
        assert end <= 512
    assert sum(n for s in bins.values() for _, n in s) / (512 * len(bins)) > 0.95
    assert packing.pack_texts(df.limit(0), "doc_id", "text", 512, 8).count() == 0


def test_boosting():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    trees = boosting.Trees(rounds=60).fit(x[:400], y[:400])
    assert ((trees.margin(x[400:]) > 0) == y[400:]).mean() > 0.93
    fit = boosting.isotonic(np.array([1.0, 2, 3, 4]), np.array([0.0, 1, 0, 1]))
    assert list(boosting.calibrated(np.array([0.5, 1, 2.5, 9]), fit)) == [0, 0, 0.5, 1]
    assert len(trees.margin(x[:0])) == 0


def examples_only():
    n = abuse.N_FEATURES
    return abuse.train(np.zeros((0, n)), np.zeros(0), np.zeros(0, int), abuse.Words())


def test_abuse(spark):
    model = examples_only()
    bad = ["You are a stupid moron.", "The clerk of this desk is a f**king idiot.", "What a s t u p i d pig this author is.", "Du bist ein Idiot, du Arschloch.", "These immigrants are vermin, deport them.", "Eres un imbécil de mierda."]
    good = ["The rim of the valve is blue.", "Find the mass of the beam.", "Thank you for the quick answer to question 4."]
    assert (model.score(bad) >= 0.5).all() and (model.score(good) < 0.5).all()
    df = spark.createDataFrame([(1, bad[0], "s", 9.0), (2, None, "s", 9.0), (3, "x " * 50_000, None, 9.0), (4, " \n", "s", 9.0)], "doc_id long, text string, source string, score double")
    got = {r.doc_id: r.score for r in abuse.score_documents(df, model, keep=("source",)).collect()}
    assert got[1] >= 0.5 and got[2] == 0 and got[3] < 0.5 and got[4] == 0
    assert abuse.score_documents(df.limit(0), model).count() == 0


def test_abuse_log_odds():
    counts = {"vile": np.array([[0, 4], [0, 4]]), "the": np.array([[8, 8], [8, 8]]), "rare": np.array([[0, 1], [0, 1]])}
    size = np.array([[10, 10], [10, 10]])
    assert set(abuse.log_odds(counts, size)) == {"vile"} and abuse.log_odds(counts, size)["vile"] > 1
    assert abuse.log_odds({"vile": np.array([[0, 0], [0, 4]])}, size, without=1) == {}
    assert abuse.nearest([3, 9], [9, 14]) == 5 and abuse.nearest([3], []) == 99 and abuse.nearest([4, 8], [1, 4, 10]) == 2
    words = abuse.Words({"vile": 2.0})
    assert words.look("V1le") == (0, 1, 2.0) and words.look("plain") is None


@pytest.mark.parametrize("without", ["", *abuse.GROUPS[:5]])
def test_abuse_held_out(spark, without):
    """Trained on sf0.1, measured on labels of the small check data whose
    texts the model has not seen; also with one family of words taken out of
    the lists. Some labels are wrong by design, so 1 can't be reached."""
    got = held_out(spark, {w: b & ~(1 << abuse.GROUPS.index(without)) for w, b in abuse._LEXICON.items()} if without else None)
    assert got[0] > 0.9 and got[1] > 0.88


def held_out(spark, groups):
    d = {s: (spark.read.parquet(f"/root/testdata/{s}/documents.parquet"), spark.read.parquet(f"/root/testdata/{s}/labels.parquet")) for s in ("sf0.1", "check_s")}
    model = abuse.fit(*d["sf0.1"], groups=groups)
    seen = {r.text for r in abuse.labelled(*d["sf0.1"]).select("text").collect()}
    rows = [(r.text, r.y) for r in abuse.labelled(*d["check_s"]).select("text", "y").collect() if r.text not in seen]
    found, y = model.score([t for t, _ in rows]) >= 0.5, np.array([v for _, v in rows])
    return (found & (y == 1)).sum() / found.sum(), (found & (y == 1)).sum() / (y == 1).sum()


def test_abuse_without_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    assert abuse.fit(docs, labels.limit(0)).score(["x"])[0] < 0.5


def test_examples_are_not_from_the_corpus(spark):
    """No example shares a run of four words with a document."""
    runs = lambda t: {tuple(w[i : i + 4]) for w in [words(t)] for i in range(len(w) - 3)}
    own = set().union(*(runs(t) for t, _ in lexicon.EXAMPLES))
    for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect():
        assert not own & runs(r.text or ""), own & runs(r.text)


def test_scan_parts():
    assert scan_repair.confusion_cost("matrix", "rnatrix") == 1 and scan_repair.confusion_cost("shielded", "shieldecl") == 1
    assert scan_repair.confusion_cost("coastal", "coastal") == 0 and scan_repair.confusion_cost("coastal", "postal") == 4
    for line, want in {"Page 7 of 23": 7, "- 12 -": 12, "[9]": 9, "lO": 10, "iv": 4, "p. 3": 3, "p12": 12, "S. 12": 12, "Page twelve": 12, "twenty-one": 21, "१२": 12, "Page 12 | 30": 12, "Turn over": None, "9 lamps": None, "": None}.items():
        got = scan_repair.number_parts(line)
        assert (got and got[0][0][1]) == want


@pytest.fixture(scope="module")
def number_model():
    return scan_repair.train_numbers()


@pytest.mark.parametrize("line", ["Page twelve", "twelve", "१२", "p12", "S. 12", "Page 12 | 30", "- 12 -", "12", "xii", "Seite 12 von 40", "1Z".replace("Z", "2")])
def test_page_numbers(line, number_model):
    model = number_model
    lines = ["the first line of the page is here.", "and a second one, which goes on", "to the third.", line]
    assert model.margin(np.array([scan_repair.number_features(lines, [0, 1, 2, 3], 3, 12, False)]))[0] > 0
    lines = ["the first line of the page is here.", "12", "and a second one, which goes on", "to the third and the", "value of the mass in the vessel is then", "47."]
    for at in (2, 5):
        f = scan_repair.number_features(lines, list(range(6)), at, 12, False)
        assert f is None or model.margin(np.array([f]))[0] < 0


WORDS = "between measure estuary gradient reading surface current method station analyst density because harvest changes pressure library student weather mixture surveys".split()


def page(rnd, exam, number, noisy):
    lines, notes = [f"Final Paper in Optics {exam}"], [(0, "running_line", "")]
    body = [rnd.choice(WORDS) for _ in range(90)]
    if noisy:
        body[5], notes = "rneasure", [*notes, (1, "misread", "measure")]
    for k in range(0, 90, 9):
        lines.append(" ".join(body[k : k + 9]) + ("." if k % 27 == 18 else ""))
    if noisy:
        lines[4], lines[5] = " ".join(lines[4].rstrip(".").split()[:-1]) + " esti-", "uary " + lines[5]
        lines[4], lines[5] = lines[4].replace("esti-", "estu-"), lines[5].replace("uary", "ary", 1)
        notes.append((4, "split_word", "estuary"))
    lines.append(f"Page {number} of 30")
    notes.append((len(lines) - 1, "page_number", ""))
    return "\n".join(lines), notes


def test_scan_repair(spark):
    rnd = random.Random(7)
    pages, want = [], set()
    for i in range(60):
        text, notes = page(rnd, f"E{i % 3}", i, i % 4 == 0)
        pages.append((i, f"E{i % 3}", i, text, 0))
        want |= {("page", i, *n) for n in notes}
    pages += [(100, "E0", 3, None, 0), (101, None, None, "", 0), (102, None, 1, "\n \n", 0), (103, "E1", 2, "x" * 30_000, 0)]
    blocks = [(1, "E1", 2, "the current rneasure of the station"), (2, None, None, None)]
    p = spark.createDataFrame(pages, "page_uid long, exam_code string, page_number int, raw_text string, kind int")
    b = spark.createDataFrame(blocks, "block_id long, exam_code string, page_number int, raw_text string")
    got = {(r.kind, r.id, r.line_no, r.noise_kind, r.repaired) for r in scan_repair.repairs(p, b).collect()}
    assert want | {("block", 1, 0, "misread", "measure")} <= got
    assert len(got - want) <= 3
    texts = {(r.kind, r.id): r.text for r in scan_repair.paragraphs(p, b).collect()}
    assert texts["block", 1] == "the current measure of the station"
    assert "estuary" in texts["page", 0] and "Page" not in texts["page", 0] and "\n" not in texts["page", 0]
    assert scan_repair.repairs(p.limit(0), b.limit(0)).count() == 0


def test_tree_bounds():
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (400, 4)) / 5
    trees = boosting.Trees(rounds=20, depth=4).fit(x, (x[:, 0] + x[:, 2] * x[:, 3] > 0.8).astype(float))
    least, most = trees.bounds(x)
    assert (least == trees.margin(x)).all() and (most == trees.margin(x)).all()
    free = x.copy()
    free[::2, 2], free[::3, 3] = np.nan, np.nan
    least, most = trees.bounds(free)
    for a, b in itertools.product(np.linspace(-0.1, 1.1, 13), repeat=2):
        given = free.copy()
        given[:, 2], given[:, 3] = np.where(np.isnan(free[:, 2]), a, free[:, 2]), np.where(np.isnan(free[:, 3]), b, free[:, 3])
        got = trees.margin(given)
        assert (least <= got).all() and (got <= most).all()
    assert not len(trees.bounds(x[:0])[0])


def test_likeness_only_where_open(spark, monkeypatch):
    """Lines are compared with lines common to exams for the sample and where
    the decision depends on it; before, all lines were (p6_found, F1)."""
    rnd = random.Random(8)
    pages = [(i, f"E{i % 4}", i, page(rnd, f"E{i % 4}", i, i % 4 == 0)[0]) for i in range(80)]
    p = spark.createDataFrame(pages, "page_uid long, exam_code string, page_number int, raw_text string")
    b = spark.createDataFrame([], "block_id long, exam_code string, page_number int, raw_text string")
    asked, plain = [], scan_repair.likeness

    def counted(keys, targets, by):
        if not by:
            asked.append(keys.count())
        return plain(keys, targets, by)

    monkeypatch.setattr(scan_repair, "LINES", 40)
    monkeypatch.setattr(scan_repair, "likeness", counted)
    scan_repair.repairs(p, b).collect()
    edge = {scan_repair.letters(t) for *_, text in pages for t in text.split("\n")[:3] + text.split("\n")[-3:]}
    assert sum(asked) < len(edge) / 2, (asked, len(edge))


def test_kinds_of_characters():
    rnd = random.Random(9)
    for alphabet in ("aB1 .-_", "aBé1² İß漢‐०"):
        for _ in range(200):
            line = "".join(rnd.choices(alphabet, k=rnd.randint(0, 9)))
            some = [c for c in line if c.isalpha()]
            assert scan_repair._kinds(line) == (len(some), sum(c.isdigit() for c in line), sum(c.isupper() for c in some))
            assert scan_repair.letters(line) == "".join(c for c in line.lower() if c.isalpha())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    got = queries.QUERIES[name](spark, DATA)
    rows = got.collect()
    if name in queries.ORACLE:
        con = duckdb.connect()
        con.execute(f"CREATE VIEW questions AS SELECT * FROM '{DATA}/questions.parquet'")
        cur = con.execute(queries.ORACLE[name])
        names = [d[0] for d in cur.description]
        assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(cur.fetchall())
    if name == "p7_ids":
        assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    if name == "p9_rates":
        assert sum(r.n_docs for r in rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_not_imported_by_the_rest():
    import pathlib

    root = pathlib.Path(__file__).parents[2] / "paperloom"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"^\s*(?:from|import)\s.*\bllm\b", path.read_text(), re.M), path
