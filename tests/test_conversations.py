from epiweave.operators import conversations

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_last_user_turn(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", ""), (1, 2, "assistant", "z"), (2, 0, "system", "s")], SCHEMA)
    assert [tuple(r) for r in conversations.last_user_turn(df).collect()] == [(1, 0, "a")]


def test_context_drops_empty_turns_after_the_cut(spark):
    df = spark.createDataFrame([(1, t, "tool" if t == 19 else "user", "" if t % 2 else f"t{t}") for t in range(19)] + [(1, 19, "tool", "end")], SCHEMA)
    got = conversations.context_window(df).first().context
    assert [c.text for c in got] == [f"t{t}" for t in range(4, 19, 2)] + ["end"]
    assert got[-1].role == "user"


def test_long_conversations_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, t, "user", "x") for t in range(50)], SCHEMA)
    plan = conversations.context_window(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_intents(spark):
    questions = {
        "Busco la enfermedad cuyo número crece con mayor rapidez": (None, "fastest_growing"),
        "Muéstrame el departamento que está más afectado hoy": (None, "top_region"),
        "¿Cuál es la enfermedad más común?": (None, "top_disease"),
        "¿En qué año hubo más casos?": (None, "top_year"),
        "Quiero leer el resumen corto": (None, "summary"),
        "ayuda": (None, "help"),
        "síntomas del deng": ("DENGUE", "symptoms"),
        "cómo evito el chik": ("CHIKUNGUNYA", "other_disease"),
        "¿qué es zika?": ("ZIKA", "definition"),
        "diferencia entre dengue y zika": ("DENGUE", "compare"),
        "cuántos casos": (None, "total_cases"),
        "cuántas filas": (None, "total_rows"),
        "!!!": (None, "empty"),
        "hola": (None, "other"),
        "dengue": ("DENGUE", "about_disease"),
    }
    questions["cómo evito el chik"] = ("CHIKUNGUNYA", "prevention")
    df = spark.createDataFrame([(1, i, "user", q) for i, q in enumerate(questions)], SCHEMA)
    got = conversations.tag_intents(df).orderBy("turn").collect()
    assert [(r.disease, r.intent) for r in got] == list(questions.values())
    forecast = spark.createDataFrame([(1, 0, "user", "pronóstico"), (1, 1, "user", "hola")], SCHEMA)
    assert [r.wants_forecast for r in conversations.tag_intents(forecast).orderBy("turn").collect()] == [True, False]
