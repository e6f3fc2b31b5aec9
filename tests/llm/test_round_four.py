"""Token alignment by words, and joins whose work does not grow with the square of a group."""

import public_tokenizers
import pyarrow as pa

from tests.llm.conftest import edge_texts, prose

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def test_words_are_aligned_once_and_like_whole_texts(monkeypatch):
    from metroframe.llm import token_alignment as T

    pair = T.TokenizerPair(BYTES, PIECES)
    odd = ["a▁ b", "x  y", " z", "z ", "tab\t end", "é ́a b", "　 c d", "<s> </s> <|endoftext|>", "w" * 300 + " v", "�  "]
    texts = pa.array([t for _, t in edge_texts() if t] + odd)
    whole = [c.to_pylist() for c in T._whole(pair, texts)]
    assert [c.to_pylist() for c in T._aligned(pair, texts)] == whole
    assert [c.to_pylist() for c in T._aligned(pair, texts)] == whole  # from words met before
    monkeypatch.setattr(T, "WORDS", 50)  # words are forgotten between the steps
    for k in range(len(texts)):
        assert [c.to_pylist()[0] for c in T._aligned(pair, texts.slice(k, 1))] == [c[k] for c in whole]
    monkeypatch.undo()
    seen = []
    monkeypatch.setattr(T, "_whole", lambda p, t, of=T._whole: (seen.extend(t.to_pylist()), of(p, t))[1])
    plain = " ".join(prose(7, 400).replace("\n", "").split())
    pair.words.forget()
    T._aligned(pair, pa.array([plain] * 50))
    assert sorted(seen) == sorted(set(plain.split(" ")))


def test_pairs_of_sets_that_share_many_keys_are_made_few_times(spark, monkeypatch):
    from metroframe.llm import jaccard_join as J

    # two texts of a similarity below the limit, of which many blocks are equal, linked with nothing
    base = prose(21, 3000).split()
    rows = [(k, " ".join(base[:k * 12] + [f"n{k}x{i}" for i in range(330)] + base[k * 12 + 330:])) for k in range(1, 9)]
    made = []
    monkeypatch.setattr(J, "_verified", lambda near, docs, percent, of=J._verified: (made.append(near), of(near, docs, percent))[1])
    kept = {}
    monkeypatch.setattr(J, "written", lambda df, name, of=J.written: kept.setdefault(name, of(df, name)) if name == "jaccard_rest" else of(df, name))
    got = {r["doc_id"]: r["component_id"] for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {}
    for k, text in rows:
        w = text.lower().split()
        sets[k] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    least = {k: k for k in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = min(least[a], least[b])
    assert got == least
    rest = kept["jaccard_rest"].select("key", "sid", "component", "before").collect()
    by = {}
    for r in rest:
        by.setdefault(r["key"], []).append(r)
    shared, pairs, times = 0, set(), 0
    for group in by.values():
        for x in group:
            for y in group:
                if x["sid"] < y["sid"] and x["component"] != y["component"]:
                    shared += 1
                    pairs.add((x["sid"], y["sid"]))
                    times += not set(x["before"]) & set(y["before"])
    made_here = {(r["x"], r["y"]) for r in made[1].select("x", "y").collect()}
    assert made_here <= pairs and pairs
    assert len(pairs) <= times < shared / 5
