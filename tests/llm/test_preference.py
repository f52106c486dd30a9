"""Preference formatting by brute force."""

from collections import defaultdict

from muster.llm.preference import formatted, with_other_endings


def turn(role, text):
    return f"<|{role or ''}|>\n{text or ''}<|end|>\n"


def brute(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    groups = defaultdict(list)
    for c in sorted(convs):
        groups[convs[c][0]].append(c)
    said = lambda c: sum(len(x) for r, x in convs[c] if r == "assistant")
    out = []
    for ids in groups.values():
        for k in range(0, len(ids), 2):
            a, b = ids[k], ids[k + 1] if k + 1 < len(ids) else None
            if b is not None and said(b) > said(a):
                a, b = b, a
            c, r = convs[a], convs.get(b)
            if r is None:
                own = [i for i, x in enumerate(c) if x[0] == "assistant"]
                n = own[-1] if own else len(c)
            else:
                n = next((i for i, (x, y) in enumerate(zip(c, r)) if x != y), min(len(c), len(r)))
            prompt = "".join(turn(*x) for x in c[:n])

            def side(turns):
                if turns is None:
                    return None, None
                at, mask = len(prompt), []
                for role, text in turns[n:]:
                    end = at + len(turn(role, text))
                    if role == "assistant":
                        mask.append((at + len(f"<|{role}|>\n"), end))
                    at = end
                return "".join(turn(*x) for x in turns[n:]), mask

            out.append((a, b, n, prompt, side(c)[0], side(r)[0], side(c)[1], side(r)[1]))
    return sorted(out, key=repr)


def result(df):
    spans = lambda m: None if m is None else [(s.start, s.end) for s in m]
    return sorted(((r.chosen_id, r.rejected_id, r.n_prompt_turns, r.prompt, r.chosen, r.rejected, spans(r.chosen_mask), spans(r.rejected_mask)) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, n int")


def test_documents(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert result(formatted(turns)) == brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])


def test_shared_openings_ties_and_nulls(spark):
    rows = []
    for c in range(60_000, 60_025):
        rows += [(c, 0, "system", "be kind"), (c, 1, "user", "hi"), (c, 2, "assistant", "yo" * (c % 4)), (c, 3, "user", None if c % 5 else "é"), (c, 4, "assistant", "bye")]
    rows += [(1, None, None, None), (2, 0, "user", "only"), (3, 0, "user", "q"), (3, 1, "assistant", "a" * 200_000), (4, 0, "user", "q"), (4, 1, "assistant", "a" * 200_000), (None, 0, "user", "q"), (4, 1, "assistant", "twice"), (4, 1, "assistant", "twice")]
    assert result(formatted(frame(spark, rows))) == brute(rows)


def test_given_pairs(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "good"), (2, 0, "user", "q"), (2, 1, "assistant", "bad")]
    pairs = spark.createDataFrame([(2, 1)], "chosen_id long, rejected_id long")
    (r,) = formatted(frame(spark, rows), pairs).collect()
    assert (r.prompt, r.chosen, r.rejected) == ("<|user|>\nq<|end|>\n", "<|assistant|>\nbad<|end|>\n", "<|assistant|>\ngood<|end|>\n")


def test_empty_table(spark):
    assert formatted(frame(spark, [])).collect() == []


def test_every_conversation_gets_a_rival(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    n = turns.select("conv_id").distinct().count()
    pairs = formatted(with_other_endings(turns)).collect()
    assert sum(r.rejected is not None and r.rejected_mask is not None for r in pairs) >= 0.9 * n
    assert all(r.prompt and r.chosen != r.rejected and r.chosen_id // 2 == r.rejected_id // 2 for r in pairs if r.rejected_id is not None)


def test_other_endings_of_defined_cases(spark):
    rows = [(2, 0, "user", "q"), (2, 1, "assistant", "a2"), (2, 2, "user", "more"), (3, 0, None, None), (3, 5, "assistant", "a3"), (3, 5, "assistant", "b3"),
            (4, 0, "user", "no answer"), (5, 0, "assistant", "a5"), (None, 0, "user", "x"), (8, 0, "assistant", "neighbour is missing")]
    got = sorted(map(tuple, with_other_endings(frame(spark, rows)).collect()), key=repr)
    own = [(2 * c, t, r or "", x or "") for c, t, r, x in rows if c is not None]
    assert got == sorted(own + [(5, 0, "user", "q"), (5, 1, "assistant", "b3"), (5, 2, "user", "more"), (7, 0, "", ""), (7, 5, "assistant", "a2"), (7, 5, "assistant", "a2")], key=repr)
