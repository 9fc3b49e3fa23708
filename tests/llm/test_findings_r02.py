"""Cases of the second review that the earlier code left undone."""

import math
import random
from itertools import combinations

import brute
import corpus_pipeline
from tokenizers import Tokenizer
from conftest import SF_SMALL
from quarry.llm import bpe, decontam, lines


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def windows(text):
    """(first, last, bytes) of every two consecutive non-blank lines."""
    x = (text or "").split("\n")
    at = [i for i, line in enumerate(x) if line.strip(" ")]
    return [(a, b, "\n".join(x[a:b + 1])) for a, b in zip(at, at[1:])]


def passages(texts):
    """doc_id -> (text, removed): lines of all windows seen before are cut."""
    seen, out = set(), {}
    for i in sorted(texts):
        x, gone = (texts[i] or "").split("\n"), set()
        for a, b, w in windows(texts[i]):
            gone |= set(range(a, b + 1)) if w in seen else set()
            seen.add(w)
        out[i] = ("\n".join(line for k, line in enumerate(x) if k not in gone), len(gone))
    return out


def test_passages_leave_no_repeated_window(spark):
    rng = random.Random(4)
    line = lambda: " ".join(rng.choice("red green blue salt stone river paper".split()) for _ in range(9))
    short = ["\n".join(line() for _ in range(rng.choice([2, 3]))) for _ in range(60)]
    texts = dict(enumerate(short)) | {100 + i: t for i, t in enumerate(short)}  # exact copies of short texts
    texts |= {200 + i: "\n".join([line(), line(), "", t, "  ", line()]) for i, t in enumerate(short)}  # the same inside others
    texts |= {300: None, 301: "", 302: "a\na\na\na", 303: "x\n\ny\nz", 304: "x\n\ny\nx\ny", 305: "\n\n"}
    want = passages(texts)
    docs = table(spark, [*texts.items(), (None, short[0]), (7, short[7]), (400, short[3]), (400, "one line\nof its own")])
    got = lines.dedup_passages(docs).collect()
    assert len(got) == len(texts) + 4
    for r in got:
        if r.doc_id is None:
            assert (r.text, r.line_dedup.n_removed) == (short[0], 0)
        elif r.doc_id == 400:  # different texts under one id
            assert r.text in ("", "one line\nof its own")
        elif texts[r.doc_id] is None:
            assert r.text is None
        else:
            assert (r.text, r.line_dedup.n_removed) == want[r.doc_id], r.doc_id
    assert all(not want[100 + i][0] for i in range(60))
    chunked = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert any(chunked[100 + i] for i in range(60))  # what the chunk rule leaves


def overlaps(a, b, window=13, agree=10):
    """The rule of the module on every diagonal, items of any length."""
    for d in range(-len(b) + 1, len(a)):
        lo, hi = max(0, -d), min(len(b), len(a) - d)
        same = [a[d + k] == b[k] for k in range(lo, hi)]
        n = len(same)
        if n >= window:
            if max(sum(same[k:k + window]) for k in range(n - window + 1)) >= agree:
                return True
        elif n and n == len(b) and sum(same) >= math.ceil(n * agree / window):
            return True
    return False


def test_masks_hit_every_accepted_placement():
    for n in range(1, 14):
        masks = decontam.MASKS + decontam.SHORT.get(n, ())
        for bad in combinations(range(n), n - math.ceil(n * 10 / 13)):
            assert any(s + m[-1] < n and not any(s + o in bad for o in m) for m in masks for s in range(n)), (n, bad)


def test_decontamination_finds_sparse_agreement(spark):
    rng = random.Random(12)
    fresh = iter(range(10 ** 6))
    new = lambda n: [f"w{next(fresh)}" for _ in range(n)]
    items, texts = {}, {}

    def put(length, bad):
        i = len(items)
        items[i] = new(length)
        texts[i] = new(rng.randint(0, 9)) + [f"x{i}k{k}" if k in bad else w for k, w in enumerate(items[i])] + new(4)

    for length in (16, 24, 40):  # every fourth token substituted
        put(length, set(range(3, length, 4)))
    for _ in range(40):  # random triples
        put(13, set(rng.sample(range(13), 3)))
    for length in range(1, 13):  # whole short items, as many substitutions as the rule takes, and one more
        for more in (0, 1):
            for _ in range(4):
                put(length, set(rng.sample(range(length), length - math.ceil(length * 10 / 13) + more)))
    want = {(i, j) for i, a in texts.items() for j, b in items.items() if overlaps(a, b)}
    docs = table(spark, [(i, " ".join(t)) for i, t in texts.items()])
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench, decontam.Params(shortest=1)).collect()}
    assert got == want and len(want) == 3 + 40 + 12 * 4
    longer = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    joined = [{i: " ".join(t) for i, t in x.items()} for x in (texts, items)]
    assert longer == brute.leaks(*joined)


def test_pipeline_returns_decoded_texts(spark):
    texts = {1: "A short text, encoded  twice.", 2: "naïve café\nzwei Zeilen", 3: "", 4: None}
    stage = dict(corpus_pipeline.STAGES)["encoding"]
    lib = Tokenizer.from_file(bpe.default_path())
    got = stage(spark, table(spark, list(texts.items())), SF_SMALL).collect()
    assert len(got) == 4
    for r in got:
        assert r.decoded == lib.decode(r.ids, skip_special_tokens=False)
