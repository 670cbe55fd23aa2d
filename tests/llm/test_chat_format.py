import hashlib
import random
from collections import defaultdict

from creditmart.llm import chat_format
from creditmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def wanted(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), digest(loss))
    return out


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    rows = [tuple(r) for r in table.collect()] + [(-7, 0, "user", probe), (-7, 1, "assistant", probe)]
    found = QUERIES["op6_chat_format"](spark, SF).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == wanted(rows)


def test_odd_turns(spark):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, None, "system", "<s>\\"), (1, 1, "assistant", "é🙂 \n\x00"),
        (1, 1, "assistant", "é🙂 \n\x00"), (None, 0, None, "x"), (2, 5, "odd <|text|> role", "<|end|><|turn|>user<|text|>"),
        (3, 0, "assistant", "long " * 60_000), (3, 1, "user", "\\</s>\\\\<<SYS>>"),
    ]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, ids int")
    turns = chat_format.formatted(df)
    found = {r.conv_id: r for r in chat_format.read_back(turns).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in found.items()} == wanted(rows)
    written, tokens = defaultdict(int), defaultdict(int)
    for r in sorted(turns.collect(), key=lambda r: (str(r.conv_id), r.place)):
        written[r.conv_id] += len(r.written)
        assert r.token_start == tokens[r.conv_id]
        tokens[r.conv_id] += len(r.ids)
        marks = [i for i in r.ids if i >= 50_257]
        assert marks == ([50_257] if r.place == 0 else []) + [50_258, 50_259, 50_260]
    assert {c: r.formatted_chars for c, r in found.items()} == written
    assert chat_format.formatted(df.where("conv_id = 99")).collect() == []
    assert chat_format.read_back(chat_format.formatted(df.where("conv_id = 99"))).collect() == []


def test_escaping_is_reversible():
    rng = random.Random(2)
    parts = [*chat_format.CONTROL, "\\", "<", "s>", "a", "|", "[", "\n"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 8)))
        safe = chat_format.escaped(text)
        assert chat_format.unescaped(safe) == text
        assert not any(control in safe for control in chat_format.CONTROL)
