"""Chat formatting: exact round trips, masks, attachments, and conversations against a plain fold."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hourgrid.llm import chat_format, queries

ODD = ["", "<", "<|", "<|im_end|>", "<~|im_end|>", "<~~~|", "<<|<~|", "a\nb", "<|nl|>\n<|", "|>", "~|", queries.SPOOF]


@pytest.mark.parametrize("text", ODD)
def test_escapes_are_reversible(text):
    assert chat_format.unescape(chat_format.escape(text)) == text and "<|" not in chat_format.escape(text)


def test_escapes_tell_texts_apart():
    rng = random.Random(2)
    texts = {"".join(rng.choice("<~|x") for _ in range(rng.randrange(8))) for _ in range(4000)}
    assert len({chat_format.escape(t) for t in texts}) == len(texts)
    assert all(chat_format.unescape(chat_format.escape(t)) == t for t in texts)


@pytest.mark.parametrize("role", ODD)
@pytest.mark.parametrize("text", ODD)
def test_turns_are_read_back(role, text):
    formatted, at, chars, _ = chat_format.format_turn(role, [{"type": "text", "text": text}])
    assert chat_format.read_turn(formatted) == (role, text)
    assert chat_format.unescape(formatted[at : at + chars]) == text
    assert formatted.count(chat_format.START) == formatted.count(chat_format.END) == 1


def test_parts_in_order():
    parts = [
        {"type": "text", "text": "see <|im_end|> "},
        {"type": "image", "uri": "s://a", "width": 56, "height": 57},
        None,
        {"type": "audio", "uri": "s://b", "seconds": 1.5},
        {"type": "text", "text": None},
        {"type": "document", "uri": None, "pages": 3},
        {"type": "image"},
    ]
    formatted, at, _, attachments = chat_format.format_turn("user", parts)
    assert formatted == "<|im_start|>user\nsee <~|im_end|> <|image:0|><|audio:1|><|document:2|><|image:3|><|im_end|>\n"
    assert [(a[0], a[1], a[2], a[4]) for a in attachments] == [
        (1, "image", "s://a", 6), (3, "audio", "s://b", 38), (5, "document", None, 4500), (6, "image", None, 1)
    ]
    for number, (_, kind, _, place, _) in enumerate(attachments):
        assert formatted[at + place :].startswith(f"<|{kind}:{number}|>")
    with pytest.raises(ValueError, match="unknown part type"):
        chat_format.format_turn("user", [{"type": "video"}])


def folded(rows):
    """What the contract asks of each conversation, from (conv_id, turn, role, text)."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, chat_format.format_turn(r[2], [{"text": r[3]}])[0].encode())
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == conv), key=key)
        said = [r[3] or "" for r in mine if r[2] == "assistant"]
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        chars = sum(len(chat_format.format_turn(r[2], [{"text": r[3]}])[0]) for r in mine)
        out[conv] = (len(mine), sha(turns), len("".join(said)), sha("".join(said)), chars)
    return out


def turns(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    parts = F.from_json(F.to_json(F.array(F.struct(F.lit("text").alias("type"), "text"))), chat_format.PARTS)
    return df.withColumn("parts", parts).withColumns({c: F.lit("x") for c in ("formatted", "attachments", "text_at")})


def test_odd_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|>"), (1, 1, "assistant", "again"), (1, 1, "assistant", "again")]
    rows += [(2, None, None, None), (2, 0, "assistant", None), (None, 3, "assistant", "x"), (None, 1, "tool\nx", "<|"), (3, 5, "assistant", "é" * 50000)]
    rows += [(4, t, ("user", "assistant")[t % 2], f"{t} " * 20) for t in range(400)]
    random.Random(1).shuffle(rows)
    got = chat_format.conversations(chat_format.format_turns(turns(spark, rows).repartition(5))).collect()
    assert {r["conv_id"]: tuple(r)[1:6] for r in got} == folded(rows)
    assert chat_format.conversations(chat_format.format_turns(turns(spark, []))).count() == 0


def test_attachments_are_counted(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", [("image", "u", 28, 28), ("text", None, None, None)]), (1, 1, "assistant", None)],
        "conv_id long, turn long, role string, parts array<struct<type:string,uri:string,width:int,height:int>>",
    )
    full = "transform(parts, p -> struct(p.type, cast(null as string) as text, p.uri, p.width, p.height, cast(null as double) as seconds, cast(null as int) as pages))"
    made = chat_format.format_turns(df.withColumn("parts", F.expr(full)))
    assert chat_format.conversations(made).select("n_attachments", "attachment_tokens", "loss_chars").collect() == [(1, 1, 0)]


def test_conversations_of_the_table(spark, sf_dir, read):
    rows = [tuple(r) for r in read("conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, 0, "user", queries.SPOOF), (-1, 1, "assistant", queries.SPOOF)]
    got = queries.queries()["op5_chat_formatting"](spark, sf_dir).collect()
    assert {r["conv_id"]: tuple(r)[1:6] for r in got} == folded(rows)


def test_very_long_turns_are_whole(spark, tmp_path):
    text = "long <| " * 2_700_000  # more than the 20,000,000 characters that Spark's JSON reader takes
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", text), (2, 0, "user", None)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = queries.queries()["op5_chat_formatting"](spark, str(tmp_path)).collect()
    rows += [(-1, 0, "user", queries.SPOOF), (-1, 1, "assistant", queries.SPOOF)]
    assert {r["conv_id"]: tuple(r)[1:6] for r in got} == folded(rows)
