import random

from geoloom.llm import perspectives as pv

SCHEMA = "conv_id long, turn long, role string, text string, piece string, mask string"


def brute(rows):
    """The whole rendering and its mask, for every dialogue and participant."""
    said = {}
    for c, t, r, x, *_ in rows:
        name = "".join("_" if a in "<|>\n\r" else a for a in ("unknown" if r is None else r))
        said.setdefault(c, []).append((-(1 << 62) if t is None else t, name, (x or "").replace("<|", "< |")))
    out = {}
    for c, messages in said.items():
        for p in {n for _, n, _ in messages} - {"system"}:
            text, mask = "", []
            for _, n, x in sorted(messages):
                text += "<|assistant|>\n" if n == p else "<|system|>\n" if n == "system" else f"<|user name={n}|>\n"
                if n == p:
                    mask.append([len(text), len(text) + len(x) + 7])
                text += x + pv.END
            out[c, p] = (len(messages), text, mask)
    return out


def corpus():
    rng = random.Random(1)
    rows = [(rng.randint(0, 30), rng.randint(0, 900), rng.choice(["user", "assistant", "system", "Ann", "Bob|>", None]), rng.choice(["hi", "é😀", "<|end|>\n", None, "", "x" * 5000]), "", "") for _ in range(600)]
    rows += [(50, i // 3, "system" if i == 0 else f"P{i % 4}", f"m{i % 7}", "", "") for i in range(900)]  # one long dialogue
    rows += [(51, 7, "user" if i % 3 else "Ann", "same", "", "") for i in range(300)]  # one turn number, equal messages
    return rows + rows[:5] + [(None, None, "user", "a", "", ""), (None, 3, "Ann", "b", "", ""), (99, 1, "system", "alone", "", ""), (98, -5, "user", "n", "", "")]


def test_pieces_concatenate_to_every_perspective(spark, monkeypatch):
    for piece, block, salt in ((256, 1024, 16), (10, 4, 3)):
        monkeypatch.setattr(pv, "PIECE", piece)
        monkeypatch.setattr(pv, "BLOCK", block)
        monkeypatch.setattr(pv, "SALT", salt)
        rows = corpus()
        got = {}
        for r in sorted(pv.rotate(spark.createDataFrame(rows, SCHEMA)).collect(), key=lambda r: r["piece"]):
            n, text, mask = got.get((r["conv_id"], r["perspective"]), (0, "", []))
            assert r["start"] == len(text) and r["piece"] * piece == n and r["n_turns"] <= piece
            got[r["conv_id"], r["perspective"]] = (n + r["n_turns"], text + r["rendered"], mask + [list(s) for s in r["mask"]])
        assert got == brute(rows)


def test_system_stands_in_every_perspective_of_a_long_dialogue(spark):
    rows = [(1, 0, "system", "rules", "", "")] + [(1, i, f"P{i % 3}", f"m{i}", "", "") for i in range(1, 301)]
    first = [r for r in pv.rotate(spark.createDataFrame(rows, SCHEMA)).collect() if r["piece"] == 0]
    assert len(first) == 3 and all(r["rendered"].startswith("<|system|>\nrules<|end|>\n") for r in first)


def test_empty_table(spark):
    assert pv.query(spark.createDataFrame([], SCHEMA)).count() == 0
