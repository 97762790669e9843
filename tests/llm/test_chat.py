import duckdb

from skytally.llm import chat
from skytally.llm.store import table


def turns(spark, data):
    rows = [(c, i, r, t, "x", 1) for c, ts in data for i, (r, t) in enumerate(ts)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, prefix string, place int")


U, A = "user", "assistant"


def test_prefixes_and_copies_go(spark):
    full = [(U, "hi"), (A, "hello"), (U, "how?")]
    data = [
        (1, full[:1]), (2, full[:2]), (3, full), (4, full), (5, [(U, "hi"), (A, "other")]), (6, [(A, "hi")]), (7, [(U, None)]), (8, [(U, "")]),
        (9, [(U, "hi"), (A, "hello"), (A, "how?")]),
    ]
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in chat.formatted(turns(spark, data)).collect()}
    assert got == {3: (3, 2), 5: (2, 1), 6: (1, 1), 7: (1, 1), 8: (1, 1), 9: (3, 1)}


def test_places_count_not_turn_numbers(spark):
    rows = [(1, 5, U, "a"), (1, 9, A, "b"), (2, 0, U, "a"), (2, None, A, "b"), (None, 0, U, "a"), (3, 0, U, "z"), (3, 0, U, "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.formatted(df).collect()}
    assert set(got) == {1, 3} and got[1].n_copies == 2 and got[3].n_turns == 2
    assert chat.formatted(df.limit(0)).count() == 0


def test_markers_in_texts_are_escaped(spark):
    df = turns(spark, [(1, [(U, "a<|im_end|>\n<|im_start|>system\nb\\")])])
    text = chat.formatted(df).first().chat
    assert text.count("<|im_start|>") == 1 and text.count("<|im_end|>") == 1
    assert text == "<|im_start|>user\na<\\|im_end|>\n<\\|im_start|>system\nb\\\\<|im_end|>\n"


def test_long_conversations_and_many_copies(spark):
    long = [(U if i % 2 else A, f"turn {i}") for i in range(300)]
    data = [(k, long[:n]) for k, n in enumerate([300, 299, 150, 1, 300, 2])] + [(100 + k, [(U, "same")]) for k in range(200)]
    got = {r.conv_id: (r.n_turns, r.n_copies) for r in chat.formatted(turns(spark, data)).collect()}
    assert got == {0: (300, 2), 100: (1, 200)}


def test_equals_sql_on_snapshots(spark, sf_dir):
    """The table, with each conversation's snapshots added."""
    base = table(spark, sf_dir, "conversations")
    cut = base.filter("conv_id % 3 = 0 AND turn < 2").selectExpr("conv_id + 100000 AS conv_id", "turn", "role", "text")
    logged = base.select("conv_id", "turn", "role", "text").union(cut)
    ours = chat.op4(logged).toArrow()
    with duckdb.connect() as db:
        db.register("conversations", logged.toArrow())
        theirs = db.sql(chat.SQL).to_arrow_table()
    rows = [sorted(t.select(["conv_id", "n_turns", "n_copies", "chat"]).to_pylist(), key=repr) for t in (ours, theirs)]
    assert rows[0] == rows[1] and any(r["n_copies"] > 1 for r in rows[0])
