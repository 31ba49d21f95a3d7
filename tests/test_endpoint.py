"""The endpoint client: requests, retries, dead letters, reruns."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from semgraph.operators import embed, endpoint
from semgraph.operators.endpoint import Endpoint, Refused, dead_letters, endpoint_embedding
from semgraph.plans import answer


class Logged:
    """Answers in reverse and writes each request to a file of its own; refuses requests with a bad text, fails once on those with a slow one."""

    def __init__(self, folder, bad=(), slow=()):
        self.folder, self.bad, self.slow, self.seen = str(folder), bad, slow, set()

    def __call__(self, texts):
        with open(f"{self.folder}/{uuid.uuid4().hex}.json", "w") as f:
            json.dump(texts, f)
        if any(t in self.bad for t in texts):
            raise Refused("bad text")
        late = {t for t in texts if t in self.slow} - self.seen
        if late:
            self.seen |= late
            raise TimeoutError("slow")
        return [{"index": i, "embedding": [len(t), 1.0]} for i, t in reversed(list(enumerate(texts)))]


def requests(folder):
    return [json.loads(p.read_text()) for p in folder.glob("*.json")]


def test_requests_are_cut_by_number_and_characters():
    e = Endpoint(send=len, size=3, most_chars=10)
    assert list(e.requests([])) == []
    assert list(e.requests(["a", "b", "c", "d"])) == [["a", "b", "c"], ["d"]]
    assert list(e.requests(["x" * 9, "yy", "z" * 50, "", "w"])) == [["x" * 9], ["yy"], ["z" * 50], ["", "w"]]
    for wrong in ({"size": 0}, {"attempts": 0}, {"most_chars": 0}):
        with pytest.raises(ValueError):
            Endpoint(send=len, **wrong)


def test_a_request_is_all_or_none(monkeypatch):
    waits = []
    monkeypatch.setattr(endpoint.time, "sleep", waits.append)
    good = lambda texts: [{"index": i, "embedding": [float(t)]} for i, t in enumerate(texts)][::-1]
    assert Endpoint(good).ask(["4", "5", "6"]) == [[4.0], [5.0], [6.0]] and not waits
    calls = []

    def thrice(texts):
        calls.append(texts)
        return good(texts) if len(calls) > 2 else 1 / 0

    assert Endpoint(thrice, wait=8.0, longest=10.0).ask(["7"]) == [[7.0]]
    assert len(waits) == 2 and 4 <= waits[0] <= 8 and 5 <= waits[1] <= 10
    for wrong in (lambda t: good(t)[:1], lambda t: good(t) + good(t), lambda t: [{"index": 0, "embedding": [1.0]}, {"index": 0, "embedding": [1.0]}], lambda t: [{"index": i, "embedding": [0.0] * (i + 1)} for i in range(len(t))]):
        waits.clear()
        with pytest.raises(ValueError):
            Endpoint(wrong, attempts=3).ask(["1", "2"])
        assert len(waits) == 2
    calls.clear()

    def refuses(texts):
        calls.append(texts)
        raise Refused("too large")

    with pytest.raises(Refused):
        Endpoint(refuses).ask(["1"])
    assert len(calls) == 1


def test_a_rerun_asks_for_what_failed(spark, tmp_path):
    texts = [(str(i), f"text {i}") for i in range(230)] + [("same", "text 1"), ("null", None), ("empty", ""), ("long", "word " * 200_000)]
    df = spark.createDataFrame(texts, "id string, embedding_text string").coalesce(1)
    folders = [tmp_path / f"calls{i}" for i in range(3)]
    for f in folders:
        f.mkdir()

    def run(i, **how):
        return embed.embedded_batch(df, "Table", str(tmp_path / "store"), endpoint_embedding(Endpoint(Logged(folders[i], **how), wait=0.0)), 2, "m")

    frozen, stats = run(0, bad=("text 150",), slow=("text 3",))
    rows = {r["id"]: r for r in frozen.collect()}
    failed = {k for k, r in rows.items() if r["embedding"] is None}
    sent = requests(folders[0])
    poisoned = next(r for r in sent if "text 150" in r)
    # The request of the bad text fails as a whole, the null text by itself; all others have their vectors.
    assert {dict(texts)[k] for k in failed} == set(poisoned) | {None} and len(poisoned) == 100
    assert rows["150"]["embedding_error"] == rows[next(k for k in failed if k not in ("150", "null"))]["embedding_error"] == "Refused: bad text"
    assert all(r["embedding"] == [len(dict(texts)[k]), 1.0] for k, r in rows.items() if k not in failed)
    assert max(map(len, sent)) == 100 and sum(r.count("text 3") for r in sent) == 2 and sum(r.count("text 1") for r in sent) == 2
    assert stats.first().asDict() == {"label": "Table", "attempts": len(texts), "successes": len(texts) - len(failed)}

    ledger = lambda: embed.current_ledger(spark, str(tmp_path / "store"), "Table")[0]
    dead = lambda: {r["id"]: r["failures"] for r in dead_letters(spark, str(tmp_path / "store"), "Table", ledger()).collect()}
    assert dead() == dict.fromkeys(failed, 1)
    run(1)
    assert {t for r in requests(folders[1]) for t in r} == set(poisoned)
    assert dead() == {"null": 2}
    assert ledger().count() == len(texts) - 1
    run(2)
    assert requests(folders[2]) == [] and dead() == {"null": 3}
    assert dead_letters(spark, str(tmp_path), "Nothing").count() == 0


def test_too_many_failures_leave_dead_letters(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "id string, embedding_text string")
    broken = endpoint_embedding(Endpoint(Logged(tmp_path, bad=("x", "y")), wait=0.0))
    with pytest.raises(RuntimeError):
        embed.embedded_batch(df, "Table", str(tmp_path / "s"), broken, 2, "m", most_failures=1)
    assert {r["id"] for r in dead_letters(spark, str(tmp_path / "s"), "Table").collect()} == {"a", "b"}
    nothing, stats = embed.embedded_batch(df.limit(0), "Schema", str(tmp_path / "s"), broken, 2, "m", most_failures=1)
    assert nothing.count() == 0 and stats.first()["attempts"] == 0


def test_questions_get_vectors_all_or_none(spark, tmp_path):
    asked = spark.createDataFrame([(i, f"q{i}", "kept") for i in range(205)], "question_id int, question string, vector string")
    ask = lambda **how: endpoint_embedding(Endpoint(Logged(tmp_path, **how), wait=0.0))
    got = answer.embedded_questions(asked, ask(), 2)
    assert {(r["question_id"], tuple(r["vector"])) for r in got.collect()} == {(i, (len(f"q{i}"), 1.0)) for i in range(205)}
    before = len(requests(tmp_path))
    assert got.where(F.size("vector") == 2).count() == 205 and len(requests(tmp_path)) == before
    with pytest.raises(ValueError, match="Refused: bad text"):
        answer.embedded_questions(asked, ask(bad=("q7",)), 2)
    with pytest.raises(ValueError, match="dimension 2 instead of 3"):
        answer.embedded_questions(asked, ask(), 3)
    assert answer.embedded_questions(asked.limit(0), ask(), 2).count() == 0
