"""Operators 11 to 13 against brute force, with nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamstack.llm import align, line_rules, spelling
from loamstack.llm.queries import QUERIES, tokenizer_path

#: Columns with the names that operators use inside.
EXTRA = ["row", "hash", "lines", "n_host", "word", "n", "form", "chunk", "segment", "path", "pair", "digest", "host", "kept"]
ROW = "doc_id long, text string, source string"


def made(spark, rows):
    df = spark.createDataFrame(rows, ROW)
    return df.withColumns({c: F.lit("x") for c in EXTRA})


def words(rng, n, letters="abcdeé", most=9):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(n))


def texts(rng):
    line = "see our other pages and the 17 terms of use here"
    body = [words(rng, 60) for _ in range(30)]
    long = words(rng, 200_000, most=8)
    return [None, "", " \t\n", "a", "# * & <b>", *body, *[b + "\n" + line.replace("17", str(i)) for i, b in enumerate(body)], *["  " + line.upper() + "\n\n" + words(rng, 3) + "\n" + line for _ in range(12)], body[0], body[0], body[0],
            "one two three four five six seven eight " * 4, "x " * 30, "a b c d e f g h i j k l m n o p q r s t u v w x y z\n" * 3, long, long + "\n" + line, "x" * 1_000_000, "日本 " * 40 + " \u0085  end"]


def measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    count = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if count[x] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, repeated = len(w), len(covered)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), repeated, n < 20 or 100 * repeated > 30 * n


def normal(line):
    return re.sub(r"[\x20\x09-\x0D]+", " ", re.sub("[0-9]+", "0", line.lower())).strip(" ")


@pytest.mark.parametrize(("least", "share"), [(5, 0.01), (5, 0.3)])
def test_line_rules(spark, least, share):
    rng = random.Random(2)
    rows = [(i, t, rng.choice(["a", "a", "b", None])) for i, t in enumerate(texts(rng))]
    rows += [(None, "no number " + words(rng, 30), "b"), rows[5], rows[5]]
    held, hosts = defaultdict(set), defaultdict(set)
    for _, t, h in rows:
        hosts[h or ""].add(t or "")
        for x in (t or "").split("\n"):
            if x.strip(" \t\n\v\f\r"):
                held[h or "", normal(x)].add(t or "")
    gone = {k for k, v in held.items() if len(v) > least and len(v) > share * len(hosts[k[0]])}
    want = []
    for d, t, h in rows:
        m = measures(t)
        lost = sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in (t or "").split("\n") if (h or "", normal(x)) in gone)
        want.append((d, *m, not m[-1] and lost <= 0.5 * m[0], lost))
    df = made(spark, rows)
    got = line_rules.judge(df, least=least, share=share)
    key = lambda r: (r[0] is not None, *r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    cleaned = line_rules.clean(df, least=least, share=share)
    assert cleaned.columns == df.columns
    left = [(d, "\n".join(x for x in t.split("\n") if (h or "", normal(x)) not in gone)) for (d, t, h), w in zip(rows, want, strict=True) if w[-2]]
    assert sorted(((r["doc_id"], r["text"]) for r in cleaned.collect()), key=key) == sorted(left, key=key)
    assert line_rules.judge(df.limit(0)).count() == 0 and line_rules.clean(df.limit(0)).count() == 0
    assert line_rules.judge(df.drop("source"), host=None).count() == len(rows)


def near_by_force(vocabulary):
    """Words at distance one, by the words that lack one sign."""
    lacking = defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            lacking[w[:i] + w[i + 1 :]].add((w, i))
    out = defaultdict(set)
    for short, of in lacking.items():
        for a, i in of:
            if short in vocabulary:
                out[a].add(short)
                out[short].add(a)
            for b, j in of:
                if a != b and i == j:
                    out[a].add(b)
    return out


def variants_by_force(rows, least=7):
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 31 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    n = {w: c for w, c in count.items() if len(w) >= least and c >= 2}
    near, form = near_by_force(n), {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= 10 * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def test_spelling_variants(spark, monkeypatch):
    monkeypatch.setattr(spelling, "SHARD_LETTERS", 900)
    monkeypatch.setattr(spelling, "PASS_BYTES", 40_000)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 50)
    rng = random.Random(5)
    base = ["".join(rng.choices("abé", k=rng.randint(6, 9))) for _ in range(200)]
    chain = ["zzzzzzzz"] * 30000 + ["zzzzzzzzz"] * 1000 + ["zzzzzzzzzz"] * 35 + ["zzzzzzzzzzz"] * 2
    rows = [(i, " ".join(rng.choices(base, k=120))) for i in range(60)] + [(1000 + i, " ".join(chain[i::7])) for i in range(7)]
    rows += [(None, "Tieword tieworda tiewordb TIEWORD × ÷ Àéîõüÿß" * 2), (None, None), (7, ""), (7, "ABCDEFG-abcdefg 日本語abcdefgh"), (8, "q" * 20_000), (9, "q" * 20_000), (9, "tiewords " * 30), rows[3], rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in EXTRA})
    counted = spelling.count_words(df, change=spelling.dropped_letter)
    got = {tuple(r) for r in spelling.group_variants(counted).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = variants_by_force(rows)
    assert got == want and any(r[1] and r[1] != r[2] for r in want) and len(want) > 150
    assert spelling.group_variants(spelling.count_words(df.limit(0))).count() == 0


def test_trie_walk_by_force():
    rng = random.Random(6)
    vocabulary = sorted({"".join(rng.choices("ab", k=rng.randint(1, 6))) for _ in range(60)} | {"aaaa", "aaa", "aaaaa", "x", "日本"})
    shard = spelling.Shard(*[x.tobytes() for x in spelling.build_trie(vocabulary)], "\n".join(vocabulary).encode(), np.ones(len(vocabulary), np.int64).tobytes())
    a, b = shard.near(*spelling._points(vocabulary))
    pairs = list(zip(a.tolist(), b.tolist(), strict=True))
    near = near_by_force(set(vocabulary))
    assert len(pairs) == len(set(pairs)) and {(vocabulary[i], vocabulary[j]) for i, j in pairs} == {(w, x) for w, xs in near.items() for x in xs}


def aligned_by_force(rows):
    from tokenizers import Tokenizer

    both = align.sides(tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    whole = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    count, found = Counter(), []
    for d, t in rows:
        if not t:
            found.append((d, None))
            continue
        a, b = whole.encode(" " + t, add_special_tokens=False).ids, both.b.encode(t)
        sides = [[x[i] for i in ids] for ids, x in ((a, both.bytes[0]), (b, both.bytes[1]))]
        if any(b"".join(s) != (" " + t).encode() for s in sides):
            found.append((d, None))
            continue
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in sides]
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            x, y = ends[0][i], ends[1][j]
            i, j = i + (x <= y), j + (y <= x)
        parts, common = [([], [])], set(ends[0]) & set(ends[1])
        for side, (ids, stops) in enumerate(zip((a, b), ends, strict=True)):
            at = 0
            for k, e in zip(ids, stops, strict=True):
                parts[at][side].append(str(k))
                if e in common:
                    at += 1
                    if at == len(parts):
                        parts.append(([], []))
        parts = [",".join(x) + "|" + ",".join(y) for x, y in parts if x]
        found.append((d, (len(a), len(b), len(parts), links, ";".join(parts))))
        count.update(set(links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [(d, 0, 0, 0, 0, 0, 0, None) if not f else (d, *f[:3], len(f[3]), sum(count[k] == best[k[0]] for k in f[3]), sum(count[k] for k in f[3]), f[4]) for d, f in found]


@pytest.mark.parametrize("chunk", [3000, 16_000_000])
def test_alignment(spark, chunk, monkeypatch):
    monkeypatch.setattr(align, "CHUNK_CHARS", chunk)
    monkeypatch.setattr(align, "SLICE_CHARS", min(chunk, 1_000_000))
    rng = random.Random(9)
    signs = ["the", "The", "word", "don't", "we'll", "é", "ß", "日本", "😀", " ", "  ", "   ", "\n", "\t", "\x1c", " ", "\u0085", "᠎", "​", " ", "　", "▁", "1234", "...", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "\x00", "'s", "-", "—"]
    rows = [(i, "".join(rng.choices(signs, k=rng.randint(0, 30)))) for i in range(400)]
    rows += [(i, words(rng, 150, "abcdethrn é")) for i in range(400, 440)]
    rows += [(None, None), (None, " leading and trailing  "), (3, ""), (3, " "), (4, "   "), (5, "a▁b c"), (6, "x" * 200_000), (7, words(rng, 100_000)), rows[410], rows[410]]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in EXTRA})
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    got = [tuple(r) for r in align.align(df, *paths).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:4], r[7] or "")
    got, want = sorted(got, key=key), sorted(aligned_by_force(rows), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g == w
    assert align.align(df.limit(0), *paths).count() == 0
    assert align.align(df.filter("text IS NULL").withColumn("doc_id", F.lit("k")), *paths).first()["n_a"] == 0


def test_segments_begin_with_spaces():
    rng = random.Random(1)
    some = ["".join(rng.choices([" ", "  ", "a", "bc", "\n", "\t", "é", " ", " ", "—"], k=rng.randint(1, 30))) for _ in range(300)]
    values, codes, counts = align.segments(some)
    parts = [values[c] for c in codes]
    assert b"".join(parts) == "".join(" " + t for t in some).encode() and all(p.startswith(b" ") for p in parts) and counts.sum() == len(parts)
    for before, p in zip(parts, parts[1:], strict=False):
        assert p.strip(b" ") or len(p) > 1
    with pytest.raises(ValueError, match="normalisation"):
        align.check_vocabularies(tokenizer_path("word_bpe_49k.json"), tokenizer_path("piece_bpe_32k.model"))


@pytest.mark.parametrize("name", ["op11_cross_tokenizer_alignment", "op12_quality_rules", "op13_spelling_variants"])
def test_queries_give_the_contracts_columns(spark, tmp_path, name):
    rng = random.Random(3)
    made(spark, [(i, words(rng, 40), "a") for i in range(20)] + [(20, None, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES[name](spark, str(tmp_path))
    kinds = dict(got.dtypes)
    if name.startswith("op11"):
        assert kinds == {"doc_id": "bigint", **dict.fromkeys(["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"], "bigint"), "groups_sha256": "string"}
        rows = {r["doc_id"]: r for r in got.collect()}
        docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()}
        for d, *numbers, groups in aligned_by_force(list(docs.items())):
            assert tuple(rows[d])[:7] == (d, *numbers) and rows[d]["groups_sha256"] == (hashlib.sha256(groups.encode()).hexdigest() if groups else "")
    elif name.startswith("op12"):
        assert {k: kinds[k] for k in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")} == {**dict.fromkeys(["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"], "bigint"), "base_failed": "boolean", "kept": "boolean"}
        assert got.count() == 21
    else:
        assert kinds == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
