"""Labels of threads: a pluggable classifier, its prompt and answers, row states, and a rule-based one that needs no service.

The states: 3 ready, 11 claimed, 12 done, 10 to be tried again (no valid answer, or blank).
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import cut
from ..sources.store import Store
from . import state

#: A prompt and the number of the try give an answer.
Classifier = Callable[[str, int], str]
READY, CLAIMED, DONE, AGAIN = 3, 11, 12, 10
TRIES = 3


def generator(url: str, model: str, timeout: float = 60.0, post: Callable[[str, dict, float], dict] | None = None) -> Classifier:
    """A classifier that asks a server for a completion: colder and with another seed at the first try than later."""

    def send(address: str, body: dict, seconds: float) -> dict:
        request = urllib.request.Request(address, json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=seconds) as answer:
            return json.load(answer)

    def ask(prompt: str, nth: int) -> str:
        # fixed values: the parameters of a try
        options = {"temperature": 0.1 if nth == 0 else 0.3, "top_p": 0.9, "top_k": 40, "num_predict": 50, "seed": 42 + nth, "num_ctx": 8192, "num_gpu": 999}
        return (post or send)(f"{url}/api/generate", {"model": model, "prompt": prompt, "stream": False, "options": options}, timeout).get("response", "").strip()

    return ask


def by_rules(prompt: str, nth: int = 0) -> str:
    """An answer by plain rules over the thread's words: a stand-in for a model, not its equal."""
    thread = prompt.partition("Thread:\n")[2].partition("\n\nAnswer with")[0].lower() or prompt.lower()
    first, replies = thread.partition("\n")[0], thread.count("\n~")
    has = lambda *words: any(w in first for w in words)
    kind = (
        "ritual-greeting" if has("good morning", "good night", ": gm", ": gn") else "question-seeking" if "?" in first else "call-to-action" if has("mint ", "vote", "join ")
        else "market-alert" if has("price", "exploit") else "project-update" if has("release", "launch", "shipped") else "advice-giving" if has("tip", "should", "recommend")
        else "creation-showcase" if has("i made", "my art", "i built") else "noise" if len(first) < 20 else "opinion-stating"
    )
    value = (
        "economic-value" if has("airdrop", "token", "bounty") else "knowledge-transfer" if kind in ("question-seeking", "advice-giving")
        else "emotional-energy" if has("love", "thank") else "social-capital" if replies else "none"
    )
    pattern = (
        "information-seeking" if kind == "question-seeking" else "debate" if has("disagree", "wrong")
        else "show-and-tell" if kind in ("creation-showcase", "project-update") else "problem-solving" if has("fix", "bug") else "social-bonding"
    )
    return f"thread_type:{kind}\nvalue_exchange:{value}\ninteraction_pattern:{pattern}"


def parse(answer: str, vocabulary: dict[str, tuple[str, ...]] = T.LABELS) -> dict[str, str]:
    """The valid labels of an answer; see T.parse_labels, which says the same of a column."""
    out = {}
    for line in answer.strip().lower().split("\n"):
        key = next((k for k in vocabulary if k in line and ":" in line), None)
        if key and (value := line.partition(":")[2].strip()) in vocabulary[key]:
            out[key] = value
    return out


def classify(df: DataFrame, classifier: Classifier = by_rules, vocabulary: dict[str, tuple[str, ...]] = T.LABELS, tries: int = TRIES) -> DataFrame:
    """hash and the labels of df (hash, text); nulls where no try gave an answer with a valid label for each key, or the text is blank."""
    keys = list(vocabulary)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for prompt in f["prompt"]:
                found: dict[str, str] = {}
                for nth in range(tries if isinstance(prompt, str) else 0):
                    try:
                        found = parse(classifier(prompt, nth), vocabulary)
                    except Exception:  # noqa: BLE001, S112  the next try
                        continue
                    if len(found) == len(keys):
                        break
                rows.append([found[k] if len(found) == len(keys) else None for k in keys])
            yield pd.DataFrame({"hash": f["hash"].to_numpy()} | {k: [r[i] for r in rows] for i, k in enumerate(keys)})

    asked = df.select("hash", T.prompt(F.col("text"), vocabulary).alias("prompt"))
    return asked.mapInPandas(run, f"hash {df.schema['hash'].dataType.simpleString()}, " + ", ".join(f"{k} string" for k in keys))


def classify_threads(store: Store, as_of: str, classifier: Classifier = by_rules, batch_size: int = 8, max_batches: int | None = None) -> list[tuple[int, int]]:
    """Claims the newest threads that are ready and no spam, and stores their labels: (done, to be tried again) of each batch."""
    out = []

    def step(_: int) -> int:
        now = store.get("threads")
        ready = (F.col("thread_status") == READY) & (F.col("spam") == 2)
        claimed = cut(state.claim(now, ready, [F.desc("ts"), F.desc("hash")], batch_size).select("hash", F.col("blob").alias("text")))
        n = claimed.count()
        if n:
            store.put("threads", state.set_status(now, claimed, CLAIMED))
            got = classify(claimed, classifier)
            done = F.col("thread_type").isNotNull()
            delta = cut(got.withColumn("thread_status", F.when(done, DONE).otherwise(AGAIN).cast("smallint")).withColumn("classified_at", F.when(done, F.lit(as_of).cast("timestamp"))))
            store.put("threads", state.merge(store.get("threads"), delta, "hash"))
            ok = delta.where(done).count()
            out.append((ok, n - ok))
        return n

    list(state.run_batches(step, max_batches))
    return out
