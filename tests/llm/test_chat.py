from feedloom.llm import chat

SCHEMA = "pair_id long, side string, turn long, role string, text string"


def run(spark, rows):
    out = chat.preference_format(spark.createDataFrame(rows, SCHEMA)).collect()
    return {r.pair_id: (r.prompt_turns, r.prompt, r.chosen, r.rejected, [s.learn for s in r.chosen_segments], [s.learn for s in r.rejected_segments]) for r in out}


def turns(pair, side, *parts):
    return [(pair, side, k, role, text) for k, (role, text) in enumerate(parts)]


def show(*parts):
    return "".join(f"<|{role}|>\n{text}\n" for role, text in parts)


def test_prefix_is_rendered_once(spark):
    head = [("system", "s"), ("user", "q")]
    rows = turns(1, "chosen", *head, ("assistant", "good"), ("user", "t")) + turns(1, "rejected", *head, ("assistant", "bad"))
    rows += turns(2, "chosen", *head) + turns(2, "rejected", *head)
    rows += turns(3, "chosen", *head, ("assistant", "a")) + turns(3, "rejected", *head)
    rows += turns(4, "rejected", ("user", "x"))
    out = run(spark, rows)
    assert out[1] == (2, show(*head), show(("assistant", "good"), ("user", "t")), show(("assistant", "bad")), [True, False], [True])
    assert out[2] == (2, show(*head), "", "", [], [])
    assert out[3] == (2, show(*head), show(("assistant", "a")), "", [True], [])
    assert out[4] == (0, "", "", show(("user", "x")), [], [False])


def test_nulls_order_repeats_and_empty(spark):
    assert run(spark, []) == {}
    rows = [(1, "chosen", 1, "user", None), (1, "chosen", 0, None, "a"), (1, "rejected", 1, "user", ""), (1, "rejected", 0, "", "a")]
    assert run(spark, rows)[1][:2] == (2, "<||>\na\n<|user|>\n\n")
    out = chat.preference_format(spark.createDataFrame([(None, "chosen", 0, "user", "a"), (None, "rejected", 0, "user", "a"), (None, None, 0, "user", "a")], SCHEMA)).collect()
    assert sorted((r.pair_id, r.prompt, r.chosen, r.rejected) for r in out) == [(None, "", "", ""), (None, "", "", show(("user", "a"))), (None, "", show(("user", "a")), "")]
    rows = [(1, "chosen", 0, "user", "b"), (1, "chosen", 0, "user", "a"), (1, "chosen", 0, "user", "a"), (1, "rejected", None, "user", "x")]
    assert run(spark, rows)[1][2] == show(("user", "a"), ("user", "a"), ("user", "b"))


def test_native_plan(spark):
    plan = chat.op10_preference_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_against_sql(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{d}/conversations.parquet'")
    a, b = chat.op10_preference_format(spark, d).toPandas(), con.sql(chat.OP10_SQL).df()
    cols = sorted(a.columns)
    assert sorted(a[cols].values.tolist()) == sorted(b[cols].values.tolist())


def test_pairs_of_large_and_negative_ids(spark):
    big = 2**60
    ids = [big, big + 1, big + 2, big + 3, -2, -1, None]
    rows = spark.createDataFrame([(i, 0, "user", str(i)) for i in ids], "conv_id long, turn int, role string, text string")
    found = {(r.pair_id, r.side, r.text) for r in chat.paired(rows).collect()}
    assert found == {(big // 2, "chosen", str(big)), (big // 2, "rejected", str(big + 1)), (big // 2 + 1, "chosen", str(big + 2)), (big // 2 + 1, "rejected", str(big + 3)), (-1, "chosen", "-2"), (-1, "rejected", "-1"), (None, "rejected", "None")}
