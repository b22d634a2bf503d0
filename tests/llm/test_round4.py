"""Byte BPE: the two splitters of pre-tokens agree. Toxicity: examples are read once."""

from __future__ import annotations

import public_tokenizers

from cellscope.llm import byte_bpe, toxicity_knn


def test_bpe_plane_splitter_cuts_like_the_splitter():
    whole, plane = byte_bpe.splitter(public_tokenizers.PATTERN), byte_bpe.plane_splitter(public_tokenizers.PATTERN)
    for start in range(0, 0x10000, 256):
        chars = [chr(c) for c in range(start, start + 256) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}b {c} {c}{c}  {c}1{c}.'s{c}\n{c}\n\n {c}\t  {c}'{c}　 {c}" for c in chars)
        assert plane.findall(text) == whole.findall(text)


def test_bpe_takes_the_splitter_by_the_characters():
    coder = byte_bpe.codec(byte_bpe.VOCABULARY)
    for text in ("plain words 12", "Wörter ࢏　 und", "signs \U00010940\U0001f600 \U00011de0", "half \ud800 pair"):
        assert coder.pre_tokens(text) == coder.split.findall(text)


def test_toxicity_examples_are_read_once_and_in_order(spark, monkeypatch):
    rows = [(i, i % 2, f"Word{i % 3} again word{i % 5} {'tail ' * (i % 4)}") for i in range(40, 0, -1)] + [(0, 1, None), (-5, 0, "")]
    examples = spark.createDataFrame(rows, "doc_id long, toxic int, text string").repartition(5)
    seen, plain = spark.sparkContext.accumulator(0), toxicity_knn._example_vectors

    def counted(batches):
        def each():
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        return plain(each())

    monkeypatch.setattr(toxicity_knn, "_example_vectors", counted)
    ids, labels, hashes, term, counts, lengths = toxicity_knn._read_examples(examples)
    assert seen.value == len(rows)  # sorting by range read every text twice
    rows.sort(key=lambda r: r[0])
    assert (ids, labels) == ([r[0] for r in rows], [r[1] for r in rows])
    ends = [0, *lengths.cumsum().tolist()]
    for k, (_, _, text) in enumerate(rows):
        _, signed, n = toxicity_knn.Terms()([text])
        found = dict(zip(hashes[term[ends[k]:ends[k + 1]]].tolist(), counts[ends[k]:ends[k + 1]].tolist()))
        assert found == dict(zip(signed.view("uint64").tolist(), n.tolist()))
    assert [len(x) for x in toxicity_knn._read_examples(examples.limit(0))] == [0] * 6
