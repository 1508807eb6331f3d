import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from geoloom.llm import sentencepiece_match as sm

PROTO = open(sm.default_model(), "rb").read()  # noqa: SIM115
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=PROTO)
VOCABULARY = sm.Vocabulary(PROTO)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text(" abtheinr\n.é▁", max_size=80), max_size=4))
def test_equals_the_library(batch):
    assert [x.tolist() for x in sm.Encoder(VOCABULARY).encode(batch)] == LIBRARY.encode(batch)


def test_long_segments_and_round_trip(monkeypatch):
    rng = random.Random(1)
    long = ["the" * 2000, " " * 3000 + "a", "".join(rng.choices("abcdeinrst", k=5000)), "naïve 執 \x00 z\r\n" * 300, "the quick\tbrown  fox\n\n jumps"]
    got = sm.Encoder(VOCABULARY).encode(long)
    assert [x.tolist() for x in got] == LIBRARY.encode(long)
    assert [VOCABULARY.decode(x) for x in got] == long
    monkeypatch.setattr(sm, "FLUSH", 50)
    monkeypatch.setattr(sm, "REMEMBERED", 3)
    e = sm.Encoder(VOCABULARY)
    assert [[x.tolist() for x in e.encode([t])][0] for t in long * 2] == LIBRARY.encode(long * 2)


def test_suffix_array_finds_every_edge():
    text = "▁then▁the▁other".encode()
    start, length, piece = VOCABULARY.edges(sm.np.frombuffer(text, sm.np.uint8))
    got = list(zip(start.tolist(), length.tolist(), strict=True))
    assert got == sorted((i, len(b)) for b in VOCABULARY.bytes for i in range(len(text)) if text.startswith(b, i))
    assert all(VOCABULARY.bytes[p] == text[s : s + n] for s, n, p in zip(start, length, piece, strict=True))


def test_relaxation_is_the_best_path():
    v = sm.Vocabulary(PROTO)
    v.bpe = False
    v.score = -sm.np.log1p(sm.np.arange(v.size)).astype(float)
    s = "▁thinner"
    ids = v.encode_segments([s])[0].tolist()
    names = {b: int(i) for b, i in zip(v.bytes, v.ids, strict=True)}
    best = {0: (0.0, [])}
    for j in range(1, len(s) + 1):
        best[j] = max((best[i][0] + v.score[names[s[i:j].encode()]], best[i][1] + [names[s[i:j].encode()]]) for i in range(j) if s[i:j].encode() in names)
    assert sum(v.score[ids]) == pytest.approx(best[len(s)][0])


def test_tables(spark):
    rows = [(1, "some text", "x", "y"), (1, "some text", "x", "y"), (2, None, "x", "y"), (3, "", "x", "y"), (None, "a ▁b", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids string, n_tokens string")
    got = sm.encode(docs)
    assert sorted((r["doc_id"] or 0, r["token_ids"]) for r in got.collect()) == sorted((d or 0, LIBRARY.encode(t or "")) for d, t, *_ in rows)
    back = sm.decode(got.drop("text")).collect()
    assert sorted(r["text"] for r in back) == sorted(["some text", "some text", "", "", "a  b"])
    flags = {r["doc_id"]: r["round_trip"] for r in sm.encode(docs, digest=True).collect()}
    assert flags == {1: True, 2: True, 3: True, None: False}
    assert sm.encode(docs.limit(0)).count() == 0


def test_long_text_without_spaces_is_cut_where_no_piece_crosses(monkeypatch):
    rng = random.Random(3)
    text = "".join(rng.choices("的一是不了人我在有他这中大来上国个到说们为子和你地出道也时年得就那要下以生会自着去之过家学对可她里后小么心多天而能好都然没日于起还发成事只作当想看文无开手十用主行方又如前所本见经头面公同三已老从动两长知民样现分将外但身些与高意进把法此实回二理美点月明其种声全工己话儿者向情部正名定女问力机给等几很业最间新什打便位因重被走电四第门相次东政海口使教西再平真听世气信北少关并内加化由却代军产入先山五太水万市眼体别处总才场师书比住员九笑性通目华报立马命张活难神数件安表原车白应路期叫死常提感金何更反合放做系计或司利受光王果亲界及今京务制解各任至清物台象记边共风战干接它许八特觉望直服毛林题建南度统色字请交爱让认算论百吃义科怎元社术结六功指思非流每青管夫连远资队跟带花快条院变联权往展该领传近留红治决周保达办运武半候七必城父强步完革深区即求品士转量空甚众技轻程告江语英基派满式李息写呢识极令黄德收脸钱党倒未持取设始版双历越史商千片容研像找友孩站广改议形委早房音火际则首单据导影失拿网香似斯专石若兵弟谁校读志飞观争究包组造落视济喜离虽坏兰答", k=60_000))
    assert VOCABULARY.longest < 100
    monkeypatch.setattr(sm, "FLUSH", 20_000)
    parts = list(VOCABULARY.safe_cuts("▁" + text, 20_000))
    assert "".join(parts) == "▁" + text and max(len(p.encode()) for p in parts) <= 20_000 and len(parts) > 5
    assert [x.tolist() for x in sm.Encoder(VOCABULARY).encode([text, "in" * 30_000])] == LIBRARY.encode([text, "in" * 30_000])


def test_invalid_bytes(spark):
    got = sm.encode(spark.sql("select 1 as doc_id, cast(x'FF6162' as string) as text")).collect()
    assert got[0]["token_ids"] == LIBRARY.encode("\ufffdab")
