"""Every operator against a brute-force version, on small tables with awkward rows."""

import collections
import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from jobtide.llm import (backoff_lm, chat_format, decontam, line_dedup, minhash_join, piece_sampling, quality_rules, token_counts,
                         toxicity, url_filter)
from jobtide.llm.common import small_batches

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WS = re.compile(r"[^\x20\x09-\x0D]+")


def _texts(seed=0, n=60):
    rng = random.Random(seed)
    words = ["the", "of", "Thé", "end.", "ing", "nd", "中文", "▁x", "a", "tion", "x" * 30, "#$%", "été", "10", "[INST]", "</s>"]
    out = [None, "", " ", "\n", "  two  spaces ", "same line\nsame line\nother", "▁", "é b　c\x00d", "word " * 3000, "x" * 5000]
    for _ in range(n):
        out.append("".join(rng.choice(words) + rng.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(rng.randint(1, 80))))
    return out + out[-5:]


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", 7, "clash", 1) for i, t in enumerate(_texts())]
    rows += [rows[-1], (None, "the of end", "en", "s0", 0, "clash", 1)]
    schema = "doc_id long, text string, lang string, source string, n_words long, items string, kept int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def test_token_counts_equal_the_library(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted(((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in _pairs(docs)), key=repr)
    assert _rows(token_counts.count_tokens(docs, MODEL)) == want
    assert _rows(token_counts.count_tokens(docs, MODEL, chunk_chars=5)) == want


def test_chunk_maps_compose_associatively():
    machine = token_counts.transducer(MODEL)
    maps = [machine.chunk_map(c) for c in ("a the", "tion", " of", "x y", "中")]
    left = maps[0]
    for m in maps[1:]:
        left = machine.compose(left, m)
    right = maps[-1]
    for m in reversed(maps[:-1]):
        right = machine.compose(m, right)
    assert left == right == machine.scan(maps)


def test_toxicity_learns_terms_and_pairs(spark):
    rng = random.Random(3)
    plain = [f"w{k}" for k in range(40)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choices(plain, k=12)
        toxic = i % 4 == 0
        words += ["vile" + rng.choice("abc")] if toxic else []
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    rows += [(9000, None), (9001, ""), (None, "vilea")]
    labels += [(9000, None), (None, 1), (0, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit(toxicity.sample_labelled(docs, lab))
    out = {r["doc_id"]: r for r in toxicity.score(docs, machine).collect()}
    assert all((out[i]["predicted"] == 1) == (i % 4 == 0) for i in range(600) if out[i]["held_out"])
    assert out[9000]["score"] == out[9001]["score"] < 0.5 and out[None]["predicted"] == 1
    # a pair of terms scores more than the sum of its parts through the factors
    import numpy as np
    m = toxicity.Machine(0.0, np.arange(2), np.zeros(2), np.array([[2.0], [2.0]]))
    assert m.score(np.array([0, 1])) > 0.9 and m.score(np.array([0])) == 0.5
    empty = toxicity.fit(toxicity.sample_labelled(docs.limit(0), lab))
    assert {r["predicted"] for r in toxicity.score(docs, empty).collect()} == {0}


@pytest.mark.parametrize("share", [2, 5])
def test_toxicity_learns_pairs_that_say_nothing_alone(spark, share):
    """Toxic exactly where aa meets bb or cc meets dd; clean where aa meets dd or cc meets bb: every word is as frequent in either class."""
    rng = random.Random(8)
    plain = [f"word{k}" for k in range(60)]
    rows, labels = [], []
    for i in range(1500):
        toxic = i % share == 0
        pair = rng.choice([["aa", "bb"], ["cc", "dd"]] if toxic else [["aa", "dd"], ["cc", "bb"]])
        words = rng.choices(plain, k=15) + pair
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(9000, ""), (9001, None)], "doc_id long, text string")
    machine = toxicity.fit(toxicity.sample_labelled(docs, spark.createDataFrame(labels, "doc_id long, toxic int")))
    out = [r for r in toxicity.score(docs, machine).collect() if r["held_out"] or r["doc_id"] >= 9000]
    held = [r for r in out if r["doc_id"] < 9000]
    right = sum((r["predicted"] == 1) == (r["doc_id"] % share == 0) for r in held)
    assert right >= 0.9 * len(held) and len(held) > 300
    assert all(r["predicted"] == 0 for r in out if r["doc_id"] >= 9000)


def test_toxicity_score_is_the_plain_double_sum():
    rng = np.random.default_rng(4)
    m = toxicity.Machine(-0.3, np.arange(9), rng.normal(size=9), rng.normal(size=(9, 4)) * 0.5)
    for at in ([], [2], [0, 3, 8], list(range(9))):
        z = m.bias + sum(m.linear[i] for i in at) + sum(float(m.factors[i] @ m.factors[j]) for k, i in enumerate(at) for j in at[k + 1:])
        assert m.score(np.array(at, np.int64)) == pytest.approx(1 / (1 + np.exp(-z)))


def test_backoff_scores_equal_a_plain_count(docs):
    import math
    texts = [(i, (t or "").encode().lower().split()) for i, t in _pairs(docs)]
    c = [collections.Counter(tuple(w[k:k + n]) for _, w in texts for k in range(len(w) - n + 1)) for n in (1, 2, 3)]
    total = sum(c[0].values())

    def value(w, k):
        v = math.log10(c[0][(w[k],)] / total)
        for n in (2, 3):
            if k >= n - 1:
                g = tuple(w[k - n + 1:k + 1])
                v = math.log10(c[n - 1][g] / c[n - 2][g[:-1]]) if c[n - 1][g] >= 2 else v + math.log10(0.4)
        return round(v * 1e6)

    want = sorted(((i, len(w), sum(value(w, k) for k in range(len(w)))) for i, w in texts), key=repr)
    for block in (2_000_000, 50):
        assert _rows(backoff_lm.score(docs, block_words=block).select("doc_id", "n_words", "micro_logprob")) == want


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "a\\b\\\\</s>\n<s>[INST x]\n", "", None, "]", "\\", "é中", "<|im_start|>user"]
    rng = random.Random(1)
    chats = {c: [(t, rng.choice(["user", "assistant", "system", "to]ol", None, "assistant"]), rng.choice(nasty)) for t in range(rng.randint(1, 7))] for c in range(30)}
    chats[99] = [(0, "user", "only a question")]
    rows = [(c, t, r, x, "extra") for c, turns in chats.items() for t, r, x in turns] + [(None, 0, "user", "q", ""), (None, None, "assistant", "a", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)
    examples = chat_format.format_chats(df)
    got = {r["conv_id"]: r for r in chat_format.digests(examples).collect()}
    assert len(got) == len(chats) + 1
    for c, turns in chats.items():
        turns = sorted(turns, key=lambda x: x[0])
        spelled = "".join(f"{r or ''}\n{x or ''}\n" for _, r, x in turns)
        loss = "".join(x or "" for _, r, x in turns if r == "assistant")
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == (
            len(turns), hashlib.sha256(spelled.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    by_conv = collections.defaultdict(list)
    for e in examples.collect():
        by_conv[e["conv_id"]].append(e)
    for c, turns in chats.items():
        n = sum(r == "assistant" for _, r, _ in turns)
        own = sorted(by_conv[c], key=lambda e: e["example"])
        assert sum(e["loss_stop"] > 0 for e in own) == n and len(own) - n in (0, 1)
        assert all(b["formatted"].startswith(a["formatted"]) for a, b in zip(own, own[1:]))
        assert sum(len(e["formatted"]) for e in own) == got[c]["formatted_chars"]
    assert chat_format.digests(chat_format.format_chats(df.limit(0))).count() == 0


def test_piece_sampling_is_lossless_and_reproducible(docs):
    a = piece_sampling.encode_sampled(docs, MODEL)
    b = piece_sampling.encode_sampled(docs.repartition(7), MODEL)
    assert _rows(a) == _rows(b)
    assert a.where("NOT lossless").count() == 0
    want = sorted(((i, t or "") for i, t in _pairs(docs)), key=repr)
    assert _rows(piece_sampling.decode(a, MODEL)) == want
    assert _rows(a) != _rows(piece_sampling.encode_sampled(docs, MODEL, seed=1))


def test_piece_sampling_follows_the_lattice_distribution():
    import math
    lat = piece_sampling.lattices(MODEL)
    n = 20_000
    ids, counts = piece_sampling._encode_texts(lat, list(range(n)), ["thes"] * n, 0)
    got, at = collections.Counter(), 0
    for k in counts:
        got[tuple(ids[at:at + k].tolist())] += 1
        at += k

    def paths(s):
        if not s:
            yield (), 0.0
        for k in range(1, len(s) + 1):
            if s[:k] in lat.pieces.ids:
                for rest, w in paths(s[k:]):
                    yield (lat.pieces.ids[s[:k]], *rest), w + lat.alpha * lat.pieces.scores[s[:k]]

    every = dict(paths(" thes"))
    z = sum(math.exp(w) for w in every.values())
    assert set(got) <= set(every)
    assert all(abs(got[p] / n - math.exp(w) / z) < 0.015 for p, w in every.items())


def test_quality_measures_and_sketch_fences(spark, docs):
    def measures(text):
        w = WS.findall(text or "")
        windows = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
        hit = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in (text or "").split("\n") if WS.search(x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)

    judged = quality_rules.judge(docs)
    got = _rows(judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
    assert got == sorted(((i, *measures(t)) for i, t in _pairs(docs)), key=repr)
    assert judged.where("base_failed AND kept").count() == 0
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(3, 6) + str(rng.random()) for _ in range(40)), "en", f"s{i % 3}") for i in range(400)]
    rows += [(1000 + i, " ".join(f"{rng.random()}|#" for _ in range(40)), "en", "s1") for i in range(5)] + [(2000, "# one " * 20 + str(rng.random()), "xx", "rare")]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept[i] for i in range(400)) and not any(kept[1000 + i] for i in range(5))
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_sketches_merge_by_adding(docs):
    m = quality_rules.measure(docs)
    whole = {tuple(r)[:4]: r["n"] for r in quality_rules.sketches(m).collect()}
    parts = collections.Counter()
    for half in (m.where("doc_id % 2 = 0"), m.where("doc_id % 2 != 0 OR doc_id IS NULL")):
        for r in quality_rules.sketches(half).collect():
            parts[tuple(r)[:4]] += r["n"]
    assert whole == dict(parts)


def test_decontamination_finds_every_window(spark, docs):
    texts = dict(_pairs(docs))
    long = max((t for t in texts.values() if t and "word" not in t), key=len)
    items = [(1, long[100:400]), (2, "the of"), (3, "été"), (4, None), (5, "..."), (6, long[50:300]), (None, "the"), (2, "the of")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def words(t):
        return pattern.findall((t or "").translate(lower))

    want = []
    for i, t in _pairs(docs):
        w, hit, found = words(t), set(), set()
        for item, text in items:
            b = words(text)
            n = min(13, len(b))
            windows = {tuple(b[k:k + n]) for k in range(len(b) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n and item is not None else 0):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found.add(str(item))
        want.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    for block in (32 << 20, 10):
        assert _rows(decontam.verdicts(decontam.find_contamination(docs, bench, block_bytes=block))) == sorted(want, key=repr)
    assert decontam.verdicts(decontam.find_contamination(docs, bench.limit(0))).where("n_hit > 0").count() == 0


def test_url_rules_and_model(spark):
    rules = [url_filter.rule("allow", "com/"), url_filter.rule("block", "example.com/en/"), url_filter.rule("allow", "www.example.com/en/"), url_filter.rule("block", "net/es/")]
    urls = ["https://WWW.Example.com/en/1?x", "http://a.example.com/en/2#t", "http://example.com/fr", "https://x.net/es/9", "http://x.com", "no url", None, "", "ftp://://odd/es/",
            "https://notexample.com.org/en/", "https://b.org/" + "long/" * 2000]
    pages = spark.createDataFrame([(i, u, "html") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labelled = spark.createDataFrame([(f"h{i}.org", f"/spam/{i}" if i % 2 else f"/news/{i}", bool(i % 2)) for i in range(200)], "host string, path string, blocked boolean")
    out = {r["page_id"]: r for r in url_filter.filter_urls(pages, rules, labelled).collect()}
    assert len(out) == len(urls)
    assert [out[i]["rule"] for i in range(5)] == ["www.example.com/en/", "example.com/en/", "com/", "net/es/", None]
    assert [out[i]["verdict"] for i in range(4)] == ["allow", "block", "allow", "block"]
    assert (out[0]["host"], out[0]["path"]) == ("www.example.com", "/en/1") and (out[6]["host"], out[6]["path"]) == ("", "")
    assert out[8]["host"] == ":" and out[4]["path"] == ""
    fresh = spark.createDataFrame([(1, "http://new.org/spam/77"), (2, "http://new.org/news/77")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(fresh, rules, labelled).collect()} == {1: "block", 2: "allow"}
    assert {r["verdict"] for r in url_filter.filter_urls(fresh, [], labelled.limit(0)).collect()} == {"allow"}


def _line_dedup(pairs, least):
    def key(line):
        k = line.encode().strip(b" \t\n\v\f\r").lower()
        return k or None
    count = collections.Counter(k for _, t in pairs for k in {key(x) for x in (t or "").split("\n")} - {None})
    out = []
    for i, t in pairs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if count[key(x)] < least]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [16 << 20, 0])
def test_line_dedup(spark, limit):
    rng = random.Random(2)
    pool = ["Home | About", " home | about\t", "©", "unique", "x" * 4000, ""] + [f"l{k}" for k in range(30)]
    pairs = [(i if i % 9 else None, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 8)))) for i in range(80)] + [(500, None), (501, ""), (7, "l1"), (7, "l1")]
    df = spark.createDataFrame([(i, t, 5) for i, t in pairs], "doc_id long, text string, n_lines int").repartition(4)
    out = line_dedup.dedup_lines(df, min_docs=10, shards=4, broadcast_bytes=limit)
    assert _rows(out.select("doc_id", "n_lines", "n_dropped", "text")) == _line_dedup(pairs, 10)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_line_index_takes_back_what_it_took_in(spark, tmpdir_path):
    a = [(i, f"common\nl{i % 7}\nown {i}") for i in range(40)]
    b = [(100 + i, f"l{i % 7}\nlate") for i in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = line_dedup.LineIndex(spark, tmpdir_path, min_docs=10, shards=4)
    index.insert(frame(a))
    before = _rows(index.clean(frame(a)))
    assert [r[1] for r in before] == [r[3] for r in _line_dedup(a, 10)]
    index.insert(frame(b))
    both = _line_dedup(a + b, 10)
    assert [(r[0], r[1]) for r in _rows(index.clean(frame(a + b)))] == [(r[0], r[3]) for r in both]
    index.delete(frame(b))
    assert _rows(index.clean(frame(a))) == before
    assert {r["n_docs"] for r in index.counts.collect()} == {1, 5, 6, 40}


def test_cuckoo_filter_has_no_false_negatives():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(3000)]
    f = line_dedup.Cuckoo(2000)  # too small: some keys go to the stash
    for k in keys:
        f.insert(k)
    assert all(f.contains(k) for k in keys)
    for k in keys[:1500]:
        f.delete(k)
    assert all(f.contains(k) for k in keys[1500:])
    assert sum(f.contains(hashlib.md5(f"n{i}".encode()).digest()) for i in range(3000)) < 30


def _components(pairs, percent):
    sets = {}
    for i, t in pairs:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    ids = sorted(sets)
    for n, x in enumerate(ids):
        for y in ids[:n]:
            both = len(sets[x] & sets[y])
            if sets[x] and sets[y] and 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                a, b = find(x), find(y)
                comp[max(a, b)] = min(a, b)
    return {(i, len(sets[i]), find(i), find(i) == i) for i in sets}


@pytest.mark.parametrize("rows_a_list", [1024, 4])
def test_near_duplicates_equal_all_pairs(spark, monkeypatch, rows_a_list):
    monkeypatch.setattr(minhash_join, "LIST_ROWS", rows_a_list)
    monkeypatch.setattr(minhash_join, "TASK_EDGES", 10 if rows_a_list == 4 else 200_000)
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    pairs, base = [], [[word() for _ in range(rng.randint(5, 90))] for _ in range(12)]
    for i in range(150):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
            w[rng.randrange(len(w))] = word()
        if i % 5 == 0:
            w = [word() for _ in range(30)] + passage
        pairs.append((i, " ".join(w)))
    pairs += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "One  TWO"), (205, "one two three")]
    df = spark.createDataFrame([(i, t, 1) for i, t in pairs], "doc_id long, text string, component_id int").repartition(3)
    for percent in (80, 85):
        got = {tuple(r) for r in minhash_join.near_duplicates(df, percent=percent).collect()}
        assert got == _components(pairs, percent)
    assert minhash_join.near_duplicates(df.limit(0)).count() == 0


def _with_signatures(monkeypatch, matches, alike):
    """``alike(coordinate)``: SQL of the number that stands for a document's value there."""
    signatures = minhash_join.signatures

    def made(docs, *rest):
        every = range(minhash_join.COORDINATES)
        sig = "concat(" + ", ".join(f"unhex(right(hex({alike(k)}), 4))" for k in every) + ")"
        low = "array(" + ", ".join(f"cast(xxhash64({k}, {alike(k)}) % 2147483647 as int)" for k in every) + ")"
        return signatures(docs, *rest).withColumns({"sig": F.expr(sig), "low": F.expr(low)})

    monkeypatch.setattr(minhash_join, "signatures", made)
    monkeypatch.setattr(minhash_join, "match_threshold", lambda percent: matches)


@pytest.mark.parametrize("visits", [2, 100])
@pytest.mark.parametrize("rare", [2, 16])
def test_links_that_share_only_hot_refined_lists(spark, monkeypatch, visits, rare):
    """Every coordinate has a few values, so all lists are long, the rarest too; pairs of ids agree in all."""
    monkeypatch.setattr(minhash_join, "LIST_ROWS", 4)
    monkeypatch.setattr(minhash_join, "RARE_ROWS", rare)
    monkeypatch.setattr(minhash_join, "VISITS", visits, raising=False)
    _with_signatures(monkeypatch, 31, lambda k: "65536L" if k < 4 else f"65536L + pmod(xxhash64(doc_id div 2, {k}), 3)")
    pairs = [(i, " ".join(f"w{i // 2}x{j}" for j in range(40 + i % 2))) for i in range(60)]
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    assert {tuple(r) for r in minhash_join.near_duplicates(df, percent=80).collect()} == _components(pairs, 80)


def _group_and_passage(n, seed=11):
    """``n`` near copies of one text, 8 % of the words changed, and ``n`` texts of one passage and own words."""
    rng = random.Random(seed)
    fresh = iter(range(10 ** 9))
    base, passage = [f"b{k}" for k in range(200)], [f"p{k}" for k in range(60)]
    copies = [[w if rng.random() > 0.08 else f"x{next(fresh)}" for w in base] for _ in range(n)]
    return [(i, " ".join(w)) for i, w in enumerate(copies + [passage + [f"y{next(fresh)}" for _ in range(25)] for _ in range(n)])]


def test_work_on_a_group_and_a_passage_grows_with_its_size(spark, monkeypatch):
    monkeypatch.setattr(minhash_join, "LIST_ROWS", 32)
    made, listed = {}, minhash_join._listed

    def counted(rows):
        made[n] = made.get(n, 0) + rows.count()
        return listed(rows)

    monkeypatch.setattr(minhash_join, "_listed", counted)
    for n in (150, 600):
        df = spark.createDataFrame(_group_and_passage(n), "doc_id long, text string").repartition(3)
        out = minhash_join.near_duplicates(df, percent=80).cache()
        assert out.where(f"doc_id >= {n} AND NOT kept").count() == 0
    assert made[600] < 1.5 * 4 * made[150], made


def test_first_shared_follows_the_order():
    same = np.array([[True, False, True, True], [True, False, True, True], [False] * 4])
    order = np.array([[2, 1, 0, 3], [2, 1, 0, 3], [0, 1, 2, 3]], np.int8)
    assert minhash_join._first_shared(same, order, np.array([0b100, 0b101, 0b1])).tolist() == [True, True, False]
    assert minhash_join._first_shared(same, order, np.array([0b001, 0b1001, 0b11])).tolist() == [False, False, False]


def test_near_duplicates_odd_ids(spark):
    rows = [(5, "a b c d e f g"), (5, "a b c d e f g"), (3, "a b c d e f g"), (None, "a b c d e f g"), (5, "other text of the same id here"), (None, None)]
    out = sorted((tuple(r) for r in minhash_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert out == sorted([(5, 3, 3, False), (5, 3, 3, False), (3, 3, 3, True), (None, 3, None, True), (5, 3, 5, True), (None, 0, None, True)], key=repr)


def test_keep_one_keeps_every_text_of_a_repeated_id(spark):
    a, b, c = ("".join(f"{x}{j} " for j in range(20)) for x in "abc")
    rows = [(3, a, "x"), (5, a + "end", "x"), (5, b, "x"), (5, b, "y"), (5, b.upper(), "x"), (5, c, "x"), (9, c, "x"), (7, None, "x"), (None, a, "x"), (None, a, "x")]
    # of the near copies under one id one stays
    rows += [(8, " ".join(f"d{j}" for j in range(n)), "x") for n in (40, 41)]
    out = minhash_join.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4))
    assert out.columns == ["doc_id", "text", "source"]
    got = [(r["doc_id"], " ".join(r["text"].lower().split()[:2]) if r["text"] else None) for r in out.collect()]
    assert sorted(got, key=repr) == sorted([(3, "a0 a1"), (5, "b0 b1"), (5, "c0 c1"), (7, None), (None, "a0 a1"), (None, "a0 a1"), (8, "d0 d1")], key=repr)


def test_components_of_a_long_chain(spark, monkeypatch):
    monkeypatch.setattr(minhash_join, "TASK_EDGES", 7)
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)] + [(100, 99)], "a long, b long").repartition(5)
    got = {r["node"]: r["comp"] for r in minhash_join.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 100: 99}


def test_signature_miss_chance():
    assert minhash_join.match_threshold(85) > minhash_join.match_threshold(80) > 10


def test_wu_manber_items_digest():
    assert decontam.items_digest(["10", "9"]) == hashlib.sha256(b"10,9").hexdigest()
    assert decontam.build([(1, b"")]) == []


def test_all_columns_pass_unread(docs):
    judged = quality_rules.judge(docs).columns
    assert judged.count("kept") == 1 and "items" in judged
    assert docs.select(F.max("n_words")).first()[0] == 7


def test_odd_sketch_never_counts_more_than_differs():
    rng = np.random.default_rng(3)
    for n in (0, 1, 40, 3000):
        pool = np.unique(rng.integers(0, 2 ** 63, n + 50, dtype=np.uint64))
        for _ in range(20):
            x, y = (np.sort(rng.choice(pool, min(n, len(pool)), replace=False)) for _ in range(2))
            bits = sum((a ^ b).bit_count() for a, b in zip(minhash_join.odd_sketch(x), minhash_join.odd_sketch(y)))
            assert bits <= len(np.setxor1d(x, y))
