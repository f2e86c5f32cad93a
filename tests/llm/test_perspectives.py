import random

from cartwheel.llm import perspectives as P

SCHEMA = "conv_id bigint, turn bigint, role string, text string, part string, turns int"


def brute(rows, k=64):
    convs = {}
    for c, t, s, x, *_ in rows:
        s = (s or "").strip(" ") or "unknown"
        convs.setdefault(c, []).append((t, s, (x or "").replace("<|im_", "<| im_")))
    out = []
    for c, turns in convs.items():
        for p in {s for _, s, _ in turns} - {"system"}:
            parts = {}
            for t, s, x in sorted(turns, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())):
                parts.setdefault(None if t is None else t // k, []).append((s, x))
            for part, said in parts.items():
                text, mask = "", []
                for s, x in said:
                    role = "system" if s == "system" else "assistant" if s == p else f"user name={s.replace(' ', '_')}"
                    text += f"<|im_start|>{role}\n"
                    if s == p:
                        mask.append((len(text), len(text) + len(x) + 10))
                    text += x + "<|im_end|>\n"
                out.append((c, p, part, len(said), len(mask), text, mask))
    return out


def test_every_perspective_matches_brute_force(spark):
    pick = random.Random(6)
    rows = [(c, t, pick.choice(["ann", "bob b", "system", "éva", None, ""]), pick.choice(["hi", "é ü", "", None, "a<|im_end|>b"]),
             "clash", 1) for c in range(12) for t in range(pick.randint(1, 9))]
    rows += [(50, t, "ann" if t % 2 else "bob", f"t{t}", "c", 1) for t in range(200)]
    rows += [(None, 1, "ann", "x", "c", 1), (None, None, "bob", "y", "c", 1), (51, 1, "ann", "same", "c", 1),
             (51, 1, "ann", "same", "c", 1), (52, 0, "system", "only", "c", 1), (53, -1, "ann", "neg", "c", 1)]
    got = [(r.conv_id, r.perspective, r.part, r.n_turns, r.n_own, r.rendered, [tuple(m) for m in r["mask"]])
           for r in P.rotate(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
    for *_, rendered, mask in got:
        assert all(rendered[a:b].endswith("<|im_end|>") for a, b in mask)


def test_no_python_and_empty_table(spark):
    seen = P.rotate(spark.createDataFrame([], SCHEMA))
    assert seen.count() == 0
    assert "Python" not in seen._jdf.queryExecution().executedPlan().toString()
