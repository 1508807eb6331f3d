import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece

import corpus_pipeline
from geoloom.llm import decontaminate, sentencepiece_match
from tests.llm import test_jaccard_join, test_language_id, test_pii_disclosure


def tables(tmp_path):
    docs = [(i, t, lang, f"s{i % 3}", len(t)) for i, t, lang, _ in test_language_id.corpus(150)]
    n = len(docs)
    more = [docs[3][1], docs[4][1] + " ing", "1234 !!", "", None, "the er ing item of the benchmark that must not stay here ou", docs[7][1] + " a@b.org 10.0.0.1", " ".join(docs[8][1].split()[:4])]
    docs += [(n + i, t, "aa", "s", len(t or "")) for i, t in enumerate(more)]
    docs.append(docs[0])
    item = "item of the benchmark that must not stay here"
    pq.write_table(pa.table({k: list(c) for k, c in zip(("doc_id", "text", "lang", "source", "n_chars"), zip(*docs, strict=True), strict=True)}), tmp_path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [1], "text": [item]}), tmp_path / "benchmark.parquet")
    return docs, item


def brute(docs, item):
    docs = [d for d in docs if any(c.isalpha() for c in d[1] or "")]  # every text with letters is in a language of the fixture
    least = {d: c for d, _, c in test_jaccard_join.brute([(d[0], d[1]) for d in docs])}
    docs = list({d[0]: d for d in docs if least[d[0]] == d[0]}.values())
    want = decontaminate.normal(item)
    docs = [d for d in docs if want not in decontaminate.normal(d[1])]
    rows, terms = test_pii_disclosure.brute(docs)
    spans = {r[1]: r[-1] for r in rows}
    out = {}
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_match.default_model())
    assert not terms
    for d in docs:
        text = d[1]
        for kind, s, e in reversed([x.split(":") for x in spans[d[0]].split(",") if x]):
            text = f"{text[: int(s)]}[{kind.upper()}]{text[int(e) :]}"
        out[d[0]] = (text, d[2], d[3], len(text), library.encode(text))
    return out


def test_pipeline(spark, tmp_path):
    docs, item = tables(tmp_path)
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "token_ids"]
    rows = got.collect()
    want = brute(docs, item)
    assert {r["doc_id"]: tuple(r)[1:] for r in rows} == {d: (*x[:4], x[4]) for d, x in want.items()}
    assert len(rows) == len(want)


def test_stages_on_no_rows(spark, tmp_path):
    tables(tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0 and docs.columns[: len(columns)] == columns
