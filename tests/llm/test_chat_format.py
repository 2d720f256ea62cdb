import hashlib
import itertools

from aerocast.llm import chat
from pyspark.sql import functions as F

SCHEMA = "conv_id long, turn long, role string, text string"
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "<", "[", "<\\s>", "[\\\\/INST]", " [/INST]", "x\n"]


def turns(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_round_trip_of_control_strings(spark):
    texts = ["".join(p) for n in (1, 2) for p in itertools.product(MARKS, repeat=n)]
    roles = ["user", "assistant", "system", "", "[/ROLE] user"]
    rows = [(i, j, roles[(i + j) % len(roles)], t) for i in range(3) for j, t in enumerate(texts)]
    out = chat.format_conversations(turns(spark, rows)).withColumn("back", chat.parse(F.col("formatted")))
    out = out.withColumn("loss", chat.loss_text(F.col("formatted"), F.col("loss_spans"))).collect()
    for r in out:
        mine = [(x[2], x[3]) for x in rows if x[0] == r.conv]
        assert r.identical and [(t.role, t.text) for t in r.back] == mine
        assert r.loss == "".join(t for role, t in mine if role == "assistant")


def test_defined_results(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 0, "assistant", "é🙂"), (2, 1, "assistant", "b"), (2, 0, "user", "a")]
    out = {r.conv: r for r in chat.format_conversations(turns(spark, rows).withColumn("piece", F.lit(1))).collect()}
    assert out[2].formatted == "<s>[INST] a [/INST]</s><s>b</s>"
    assert [(s.start, s.end) for s in out[2].loss_spans] == [(26, 27)]
    assert out[1].formatted == "<s>[ROLE]  [/ROLE] first</s>" + "<s>[INST]  [/INST]</s>" * 2
    assert out[None].formatted == "<s>é🙂</s>" and all(r.identical for r in out.values())
    assert chat.format_conversations(turns(spark, [])).count() == 0


def test_plain_turns_are_not_escaped(spark):
    r = chat.render_turns(turns(spark, [(1, 0, "user", "a < b [x] \\s>"), (1, 1, "user", "</s>")])).orderBy("turn").collect()
    assert [x.escaped for x in r] == [False, True] and r[1].content == "<\\/s>"


def test_query(spark):
    from aerocast.llm.queries import CONTROL_TEXT, op2_chat_format
    r = op2_chat_format(spark, "/root/testdata/sf0.001").where("conv_id = -7").first()
    assert r.n_turns == 2 and r.loss_chars == len(CONTROL_TEXT)
    assert r.loss_sha256 == hashlib.sha256(CONTROL_TEXT.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{CONTROL_TEXT}\nassistant\n{CONTROL_TEXT}\n".encode()).hexdigest()


def test_very_long_text(spark):
    text = "</s>[INST] a\\ <" * 150_000
    r = chat.format_conversations(turns(spark, [(1, 0, "user", text), (1, 1, "assistant", text)])).withColumn("back", chat.parse(F.col("formatted"))).first()
    assert r.identical and [t.text for t in r.back] == [text, text]
