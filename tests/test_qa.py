"""Question routing, glossary precedence, length gate and advice filter."""

from pyspark.sql import functions as F

from quarterline.operators import qa as Q

ROUTED = {
    "What does revenue mean?": "glossary",
    "What is the difference between QoQ and YoY?": "glossary",
    "Did the company perform well?": "performance",
    "What drove the company's growth?": "drivers",
    "What was the main headwind?": "headwind",
    "Are the company's margins strong?": "margin",
    "What should I investigate next?": "investigate",
    "Explain this quarter like I do not know finance.": "explain",
    "What is the main headwind?": "glossary",
    "What is the stock price going to be?": "none",
}


def test_routes(spark):
    df = spark.createDataFrame([(q,) for q in ROUTED], "q string")
    got = {r.q: r.r for r in df.select("q", Q.route(Q.normalize(F.col("q"))).alias("r")).collect()}
    assert got == ROUTED


def test_glossary_longest_alias_and_gate(spark):
    df = spark.createDataFrame([("what is gross margin",), ("gross margin please",), ("explain net income",)], "n string")
    got = [r[0] for r in df.select(Q.glossary_label(F.col("n"))).collect()]
    assert got == ["Gross margin", None, "Net income"]


def test_length_gate(spark):
    df = spark.createDataFrame([("  ",), ("a",), ("x" * 500,), (" " + "x" * 500 + "\n",), ("x" * 501,)], "q string")
    got = [r[0] for r in df.select(Q.stripped_length(F.col("q"))).collect()]
    assert [1 <= n <= 500 for n in got] == [False, True, True, True, False]


def test_advice_words_are_whole_words(spark):
    texts = {"You should BUY now": True, "a holding pattern": False, "price target raised": True,
             "reinvestment": False, "our forecasts": True, "éinvest": False, "invest.": True}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.f for r in df.select("t", Q.advice_flag(F.col("t")).alias("f")).collect()}
    assert got == texts


def test_no_question_is_lost_and_real_text_is_routed(spark):
    from quarterline.sources import testdata

    turns = [(c, t, r, f"what is gross margin {c}" if r == "user" else f"answer {c}/{t}") for c in range(60)
             for t, r in enumerate(("user", "assistant", "user"))]
    conversations = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    periods = spark.createDataFrame([(e, 2001, "Q2") for e in range(10)], "entity_id long, fiscal_year int, fiscal_period string")
    q = testdata.fx_questions(conversations, periods)
    assert q.count() == 2 * 120 and q.where("session_id >= 0 and question not like 'what is gross margin%'").count() == 0
    summary = q.withColumns({"headline": F.lit("h"), "pos1": F.lit(None).cast("string"), "pos2": F.lit(None).cast("string"),
                             "neg1": F.lit(None).cast("string"), "source_ids": F.array(F.lit("s")),
                             "takeaways": F.array(F.struct(F.lit("t").alias("text")))})
    a = Q.answer(summary)
    assert a.count() == 240
    assert a.where("fiscal_year is null and mode <> 'insufficient_context'").count() == 0
    assert {r.route for r in a.where("session_id >= 0 and fiscal_year is not null").select("route").collect()} == {"glossary"}
    assert {len(r.sources_named) for r in a.where("route = 'glossary'").collect()} == {0}


def test_history_holds_answered_exchanges(spark):
    from quarterline.sources import testdata

    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(12)] + [(2, 0, "user", "alone"), (2, 1, "user", "again")]
    conversations = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    asked = conversations.where("role = 'user'").select(F.col("conv_id").alias("session_id"), F.col("turn").cast("int").alias("turn"))
    h = {(r.session_id, r.turn): [(x.question, x.answer) for x in r.history]
         for r in Q.history(asked, testdata.fx_exchanges(conversations)).collect()}
    assert h[(1, 0)] == [] and h[(1, 4)] == [("t0", "t1"), ("t2", "t3")]
    assert h[(1, 10)] == [("t4", "t5"), ("t6", "t7"), ("t8", "t9")] and h[(2, 1)] == []


def test_history_of_a_long_session(spark):
    from quarterline.sources import testdata

    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(80)] + [(1, 80, "user", "open"), (1, 81, "user", "last")]
    conversations = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    asked = conversations.where("role = 'user'").select(F.col("conv_id").alias("session_id"), F.col("turn").cast("int").alias("turn"))
    h = {r.turn: [(x.turn, x.question, x.answer) for x in r.history] for r in Q.history(asked, testdata.fx_exchanges(conversations)).collect()}
    pairs = [(t, f"t{t}", f"t{t + 1}") for t in range(0, 80, 2)]
    assert len(h) == 42
    for turn, got in h.items():
        assert got == [p for p in pairs if p[0] < turn][-3:]
