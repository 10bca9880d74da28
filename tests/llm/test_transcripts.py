import itertools

import numpy as np

from cauce.llm import transcripts as T
from conftest import SF01
from llm.helpers import words

SCHEMA = "conv_id long, turn long, role string, text string, lines string, states int, `at` int"


def table(spark, rows):
    return spark.createDataFrame([r + ("x", 1, 2) for r in rows], SCHEMA)


def talk(n, turns, seed=0):
    return [(c, t, "user" if t % 2 == 0 else "assistant", words(5 + t % 2 * 20, seed + c * 50 + t) + ("?" if t % 2 == 0 else "."))
            for c in range(n) for t in range(turns)]


def test_viterbi_is_brute_force():
    r = np.random.default_rng(3)
    model = T.Model(r.random(6) * 9, r.random((6, 6)) * 9, [r.random((6, n)) * 9 for n in T.SIZES])
    for n in range(1, 5):
        seen = [tuple(int(r.integers(0, k)) for k in T.SIZES) for _ in range(n)]
        e = model.scores(seen)
        best = max(itertools.product(range(6), repeat=n), key=lambda p: model.start[p[0]] + e[0, p[0]]
                   + sum(model.step[a, b] + e[i + 1, b] for i, (a, b) in enumerate(zip(p, p[1:]))))
        (before, after), = T.chain([model.span(seen)])
        assert model.viterbi(seen, before, after) == list(best)
        for cut in range(1, n):  # pieces give the same path
            (b1, a1), (bn, an), (b2, a2) = T.chain([model.span(seen[:cut]), None, model.span(seen[cut:])])
            assert model.viterbi(seen[:cut], b1, a1) + model.viterbi(seen[cut:], b2, a2) == list(best)


def test_markers():
    for line, role, body in [("User: hello", 1, "hello"), ("### Assistant: x", 2, "x"), ("**Customer:** hm", 1, "hm"),
                             ("<|system|> be kind", 0, "be kind"), ("[AI] yes", 2, "yes"), ("q: why?", 1, "why?")]:
        (f,), (rest,) = T.observe([line])
        assert (f[0], rest) == (role + 1, body), line
    assert T.observe(["A fine day", "User manual: none"])[0][0][0] == 0


def test_roles_and_rendering(spark):
    rows = talk(40, 6)
    got = {r.conv_id: r for r in T.format_chats(table(spark, rows)).collect()}
    assert len(got) == 40
    right = sum(got[c].roles == "uauaua" for c in range(40))
    assert right >= 36
    c = next(c for c in range(40) if got[c].roles == "uauaua")
    mine = [r for r in rows if r[0] == c]
    assert got[c].chat == "".join(f"<|{r}|>\n{t}\n<|end|>\n" for _, _, r, t in mine) and got[c].n_turns == 6


def test_long_conversation_in_pieces(spark, monkeypatch):
    """Pieces of 16 turns give exactly the chat of one piece, with turns of many
    lines among them, some cut by a border."""
    rows = talk(20, 4) + [(99, t, "user" if t % 2 == 0 else "assistant",
                           "\n".join(words(3 + t % 2 * 9, 7 * t + i) for i in range(1 + t % 3))) for t in range(200)]
    whole = T.transcripts(table(spark, rows))
    model = T.fit(whole)
    one = T.parse(whole, model).where("conv_id = 99").collect()
    monkeypatch.setattr(T, "PIECE", 16)
    parts = T.parse(T.transcripts(table(spark, rows)), model).where("conv_id = 99").orderBy("piece").collect()
    assert len(one) == 1 and len(parts) == 13
    assert "".join(p.roles for p in parts) == one[0].roles and "".join(p.chat for p in parts) == one[0].chat
    assert sum(p.n_turns for p in parts) == one[0].n_turns


def test_runs_of_pieces(spark, monkeypatch):
    """Pieces chained in runs of three give the chat of one piece."""
    rows = talk(10, 4) + talk(1, 90, seed=5)[4:] + [(7, t, "user", None) for t in range(100, 140)]
    whole = T.transcripts(table(spark, rows))
    model = T.fit(whole)
    one = {r.conv_id: r.chat for r in T.parse(whole, model).collect()}
    monkeypatch.setattr(T, "PIECE", 4)
    monkeypatch.setattr(T, "RUN", 3)
    got = {}
    for r in T.parse(T.transcripts(table(spark, rows)), model).orderBy("piece").collect():
        got[r.conv_id] = got.get(r.conv_id, "") + r.chat
    assert got == one and len(one) == 10


def test_repeated_turns_are_cut(spark, monkeypatch):
    """A third of the rows share one null conversation and turn, many of them
    equal in every column: no piece holds more than a few times PIECE rows, and
    the pieces' chats, joined, are the chat of one piece."""
    hot = [(None, None, "user" if i % 3 else "assistant", words(6, i % 90)) for i in range(300)]
    hot += [(None, None, "user", "the same again")] * 200 + [(None, t, None, words(5, t)) for t in range(-3, 40)]
    rows = hot + [(3, t // 9, "user", words(4, t)) for t in range(120)] + talk(60, 6)
    whole = T.transcripts(table(spark, rows))
    model = T.fit(whole)

    def joined(pieces):
        chats = {}
        for r in T.parse(pieces, model).orderBy("piece").collect():
            a, b, c = chats.get(r.conv_id, ("", "", 0))
            chats[r.conv_id] = (a + r.roles, b + r.chat, c + r.n_lines)
        return chats

    one = joined(whole)
    monkeypatch.setattr(T, "PIECE", 16)
    cut = T.transcripts(table(spark, rows))
    sizes = [len(r.roles) for r in cut.collect()]
    assert sum(sizes) == len(rows) and max(sizes) <= 4 * 16
    assert joined(cut) == one


def test_a_turn_goes_on_over_a_border():
    states, rest = [2, 3, 3, 4, 5], ["a", "b", "c", "d", "e"]
    whole = T.render(states, rest)
    assert whole == ("ua", "<|user|>\na\nb\nc\n<|end|>\n<|assistant|>\nd\ne\n<|end|>\n")
    for cut in range(1, 5):
        x = T.render(states[:cut], rest[:cut], last=False)
        y = T.render(states[cut:], rest[cut:], before=states[cut - 1])
        assert (x[0] + y[0], x[1] + y[1]) == whole
    assert T.render([3], ["starts inside"]) == ("u", "<|user|>\nstarts inside\n<|end|>\n") and T.render([], []) == ("", "")


def test_awkward_rows(spark):
    rows = talk(5, 4) + [(50, None, "user", "no turn"), (50, 1, None, "no role"), (51, 0, "robot", None), (51, 1, "user", ""),
                         (None, 0, "user", "no conversation"), (52, 0, "user", "same"), (52, 0, "user", "same"),
                         (53, 0, "user", "long " * 50_000), (54, 0, "system", "\n\n")]
    got = T.format_chats(table(spark, rows)).collect()
    assert len(got) == len({r[0] for r in rows})
    assert T.format_chats(table(spark, [])).count() == 0


def test_query_on_table(spark):
    from cauce.llm.queries import QUERIES
    got = QUERIES["op9_transcripts"](spark, SF01).toPandas().set_index("conv_id").roles
    c = spark.read.parquet(f"{SF01}/conversations.parquet").toPandas().sort_values(["conv_id", "turn"])
    truth = c.groupby("conv_id").role.apply(lambda x: "".join(r[0] for r in x))
    assert (got == truth.loc[got.index]).mean() > 0.9 and len(got) == len(truth)
