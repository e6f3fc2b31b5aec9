"""The whole pipeline against brute force, on a small corpus with planted junk, lines, copies and leaks."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

from tests.llm.conftest import prose

LINE = "This line of boilerplate stands on many sites."


def corpus():
    """(rows, items): rows of (doc_id, text, lang, source, n_chars)."""
    r = random.Random(23)
    vocabulary = prose(70, 3000).split()
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, text(20 + 30 * k)) for k in range(4)]
    base = [text(120) for _ in range(60)]
    rows = [[k, t] for k, t in enumerate(base)]
    for k in range(10, 20):  # on ten sources
        rows[k][1] += "\n" + LINE
    near = lambda t: t.replace(t.split()[60], "changed", 1)
    rows += [[100, base[0]], [101, near(base[1])], [102, base[2]], [3, base[30]], [None, base[4]], [None, near(base[5])],
             [6, base[6]], [None, text(120)], [40, text(130)]]
    rows += [[200 + k, f"{text(40)} {item} {text(40)}"] for k, (_, item) in enumerate(items)]
    rows += [[None, f"{text(30)} {items[1][1]} {text(50)}"]]
    rows += [[300 + k, " ".join(w + "%%%" for w in text(120).split())] for k in range(30)]
    rows += [[400, "too few words"], [401, ""], [402, None]]
    return [(i, t, "en", f"s{k % 12}" if i != 6 else "s6", len(t or "")) for k, (i, t) in enumerate(rows)], items


def expected(rows, items):
    rows = [(i, t, s) for i, t, _, s, _ in rows if t and len(t.split()) >= 10 and "%%%" not in t]
    sites, places = defaultdict(set), defaultdict(list)
    for k, (i, t, s) in enumerate(rows):
        for pos, line in enumerate(t.split("\n")):
            if len(line.strip(" ")) >= 20:
                sites[line.strip(" ")].add(s)
                places[line.strip(" ")].append((i is not None, i or 0, k, pos))
    gone = {p[2:] for line, at in places.items() if len(sites[line]) >= 5 for p in sorted(at)[1:]}
    rows = [(i, "\n".join(x for pos, x in enumerate(t.split("\n")) if (k, pos) not in gone)) for k, (i, t, _) in enumerate(rows)]
    sets = [{tuple(t.lower().split()[j:j + 5]) for j in range(len(t.split()) - 4)} for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = defaultdict(list)
    for k, row in enumerate(rows):
        groups[find(k)].append(row)
    rows = [min(g, key=lambda x: (x[0] is None, x[0] or 0)) for g in groups.values()]
    return [(i, t) for i, t in rows if not any(item in t for _, item in items)]


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline
    import sentencepiece

    rows, items = corpus()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 60, 2)], "doc_id long, quality int, toxic int") \
        .write.parquet(f"{tmp_path}/labels.parquet")
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    digest = lambda t: hashlib.sha256(np.array([1, *lib.encode(t), 2], "<u4").tobytes()).hexdigest()
    want = expected(rows, items)
    got = Counter((x["doc_id"], x["ids_sha256"]) for x in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == Counter((i, digest(t)) for i, t in want)
    assert 60 < len(want) < len(rows) - 40 and sum(i is None for i, _ in want) == 1
