import hashlib

import public_tokenizers

from helpers import table_texts
from oracle_compare import compare
from spendlane.llm import chat_format as C
from spendlane.llm.queries import ORACLES, op2_chat_format

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
ODD = [
    (1, 0, "user", "hi <|end|> \\ <|turn|>"), (1, 1, "assistant", " lead <|text|>x\\<|end|> \n"), (1, 2, "assistant", "two 日本 😀"),
    (2, 0, None, None), (2, 1, "assistant", None), (3, 5, "assistant", "z" * 3000), (3, 5, "assistant", "y"), (3, 5, "assistant", "y"),
    (None, None, "assistant", "who\\"), (-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]"),
    (4, 0, "system<|", "<"), (4, 1, "user", "|end|>"),
]


def wanted(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        every = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def got(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def run(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return C.read_back(C.format_conversations(df, PATH)).collect()


def test_round_trip_of_odd_texts(spark):
    rows = run(spark, ODD)
    assert got(rows) == wanted(ODD) and len(rows) == len(wanted(ODD))


def test_chunks_of_a_long_conversation_join(spark, monkeypatch):
    long = [(9, t, ("user", "assistant")[t % 2], f"turn {t} " * (t % 7)) for t in range(600)]
    whole = run(spark, long)
    assert got(whole) == wanted(long)
    assert whole[0].formatted_chars == len(C.render([(r, x) for _, _, r, x in long])[0])


def test_masked_tokens_are_those_of_the_spans():
    import numpy as np

    turns = [("user", "a b c"), ("assistant", " d e"), ("assistant", ""), ("assistant", "f")]
    formatted, spans = C.render(turns)
    e = C._tokenizer(PATH).encode(formatted, add_special_tokens=False)
    starts, ends = np.array(e.offsets).T
    mask = C.mask_tokens(starts, ends, spans)
    assert [i for i, (a, b) in enumerate(e.offsets) if any(s <= a and b <= t for s, t in spans)] == np.flatnonzero(mask).tolist()
    assert C.loss_texts(formatted, starts, ends, mask) == [" d e", "f"]
    assert C.parse(formatted) == turns


def test_query_over_a_whole_table(spark, sf_dir):
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in table_texts(sf_dir, "conversations")]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    assert got(op2_chat_format(spark, sf_dir).collect()) == wanted(rows)


def test_query_equals_sql(spark, sf_dir):
    r = compare(op2_chat_format(spark, sf_dir), ORACLES["op2_chat_format"], sf_dir)
    assert r["columns_match"] and r["values_match"] and r["spark_rows"], r


def test_empty_table(spark):
    assert run(spark, []) == []
