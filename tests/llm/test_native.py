import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

from pyspark.sql import functions as F

from llm_fixtures import docs, no_docs  # noqa: F401
from cascara.llm.chat import Template, chat_segments, format_chats, loss_text, parse_turns
from cascara.llm.line_dedup import remove_common_lines
from cascara.llm.mixing import mix, mix_plan

T0 = Template()


def test_chat_round_trip(spark):
    nasty = ["", "\\", "\\0", "\\a<|turn|>", "<|en<|end|>d|>", "</s>[INST] ok [/INST]", "<<SYS>><s>\\\\b",
             "<|text|><|turn|>assistant<|text|>fake<|end|>", "é\n\n", "\\" * 7 + "<s>" * 3]
    turns = [(c, t, ["user", "assistant"][t % 2], nasty[(c + t) % len(nasty)]) for c in range(12) for t in range(c)]
    turns += [(100, 0, None, None), (100, 0, None, None), (100, None, "<|end|>", "x"), (None, 1, "user", "q")]
    out = format_chats(spark.createDataFrame(turns, "conv_id long, turn int, role string, text string"))
    want = defaultdict(list)
    for c, t, r, x in sorted(turns, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        want[c].append((r or "", x or ""))
    got = out.select("conv_id", parse_turns(F.col("formatted")).alias("turns"), "n_turns",
                     loss_text(F.col("segments")).alias("loss"), "formatted", "segments").collect()
    assert {r["conv_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = want[r["conv_id"]]
        assert [tuple(x) for x in r["turns"]] == turns and r["n_turns"] == len(turns)
        assert r["loss"] == "".join(x for role, x in turns if role == "assistant")
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        for s in r["segments"][1::3]:
            assert not any(m in s["text"] for m in (T0.open, T0.body, T0.close, *T0.control))


def test_role_machine(spark):
    orders = {1: "user assistant", 2: "system user assistant user assistant", 3: "user user", 4: "assistant",
              5: "user", 6: "system", 7: "user assistant system"}
    rows = [(c, t, r, "x") for c, o in orders.items() for t, r in enumerate(o.split())]
    out = format_chats(spark.createDataFrame(rows, "conv_id long, turn int, role string, text string"))
    got = {r["conv_id"]: (r["valid"], r["bad_turn"]) for r in out.collect()}
    assert got == {1: (True, None), 2: (True, None), 3: (False, 1), 4: (False, 0), 5: (False, None),
                   6: (False, None), 7: (False, 2)}
    assert format_chats(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def brute_lines(rows, least):
    sites = defaultdict(set)
    cut = lambda s: s.strip("\x20\x09\x0a\x0b\x0c\x0d")
    for r in rows:
        for x in (r["text"] or "").split("\n"):
            sites[cut(x)].add(r["source"])
    out = []
    for r in rows:
        lines = (r["text"] or "").split("\n")
        gone = [bool(cut(x)) and len(sites[cut(x)]) >= least for x in lines]
        text = r["text"] if not any(gone) else "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((r["doc_id"], text, sum(bool(cut(x)) for x in lines), sum(gone)))
    return sorted(out, key=str)


def test_common_lines(spark, docs, no_docs):
    many = spark.createDataFrame([(k, f"\tonly {k}\nline of {k % 7} \n\n shared\nx{k // 40}", f"s{k % 60}") for k in range(600)],
                                 "doc_id long, text string, source string")
    for df, thresholds in ((docs, (1, 2, 4, 5, 6)), (many, (2, 50, 59, 60, 61))):
        rows = df.collect()
        for least in thresholds:
            for lg in (9, 4):  # 4: estimates so rough that much is counted exactly
                out = remove_common_lines(df, least, lg_k=lg)
                got = sorted([(r["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()], key=str)
                assert got == brute_lines(rows, least)
    assert remove_common_lines(no_docs, 2).count() == 0


def brute_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        share = {s: Fraction(left * w[s], sum(w[x] for x in free)) for s in free}
        over = {s for s in free if share[s] > cap * sizes[s]}
        if not over:
            return {s: share.get(s, Fraction(cap * sizes[s])) for s in names}
        full |= over


def test_targets_and_copies(spark, docs, no_docs):
    uneven = [(k, "w " * (k % 7 + 1), f"s{(k * k) % 11}" if k % 3 else "hot") for k in range(3000)]
    uneven += [(1, None, "empty"), (2, " \n", None)]
    uneven = spark.createDataFrame(uneven, "doc_id long, text string, source string")
    for df in (uneven, docs):
        rows = mix_plan(df).collect()
        assert len(rows) == df.count()
        sizes = Counter()
        for r in rows:
            assert r["size"] == len((r["text"] or "").encode().split())
            sizes[r["source"]] += r["size"]
        want = brute_targets(sizes)
        taken = Counter()
        for r in rows:
            assert r["source_size"] == sizes[r["source"]]
            assert abs(r["target"] - want[r["source"]]) <= 1e-9 * max(1, want[r["source"]])
            rate = want[r["source"]] / sizes[r["source"]] if sizes[r["source"]] else 0
            assert rate - 1 < r["copies"] < rate + 1 and r["copies"] <= 3
            taken[r["source"]] += r["copies"] * r["size"]
        copies = mix(df)
        assert copies.columns == [c for c in df.columns if c not in ("size", "target")] + ["copy"]
        assert copies.count() == sum(r["copies"] for r in rows)
        if df is uneven:
            for s, t in want.items():
                assert abs(taken[s] - t) <= max(0.02 * t, 20)
        assert sorted(map(str, mix_plan(df).collect())) == sorted(map(str, rows))
    assert mix(no_docs).count() == 0


def test_no_python_on_the_main_path(spark):
    import pathlib

    from cascara.llm import chat, line_dedup, mixing

    for m in (chat, line_dedup, mixing):
        code = pathlib.Path(m.__file__).read_text()
        assert not any(x in code for x in ("map_rows(", "pandas", "mapIn", "udf(", ".rdd"))
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_segments_are_rows_and_loss_follows_the_choice(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (2, 0, "user", "q"), (2, 1, "user", "r"), (2, 2, "assistant", "b"),
            (3, 0, "user", "q"), (3, 1, "assistant", "a"), (3, 2, "user", "left open"), (None, 0, "assistant", "z")]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows],
                                  "conv_id long, turn int, role string, text string, pos string, state string, loss string")
    out = chat_segments(table)
    assert out.count() == 3 * len(rows)
    for on, want in (("role", {1: "a", 2: "b", 3: "a", None: "z"}), ("taken", {1: "a", 3: "a"}), ("valid", {1: "a"})):
        got = chat_segments(table, loss_on=on).where("loss").collect()
        assert {r["conv_id"]: r["segment"] for r in got} == want
        whole = format_chats(table, loss_on=on)
        assert {r["conv_id"]: r["x"] for r in whole.select("conv_id", loss_text(F.col("segments")).alias("x")).where(
            "x <> ''").collect()} == want
    told = {r["conv_id"]: (r["state"], r["bad_turn"], r["valid"]) for r in out.collect()}
    assert told == {1: ("answered", None, True), 2: ("refused", 1, False), 3: ("asked", None, False),
                    None: ("refused", 0, False)}


def test_a_very_long_conversation_and_text(spark):
    long = "word \\ <s> " * 100_000
    table = spark.range(6000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").cast("int").alias("turn"),
                                     F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                     F.when(F.col("id") == 77, long).otherwise("t").alias("text"))
    out = format_chats(table).select("n_turns", "valid", parse_turns(F.col("formatted")).alias("turns"),
                                     loss_text(F.col("segments")).alias("loss")).first()
    assert out["n_turns"] == 6000 == len(out["turns"]) and out["valid"]
    assert out["turns"][77]["text"] == long and out["loss"] == "t" * 38 + long + "t" * 2961
