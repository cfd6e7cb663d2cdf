"""Judge backends: functions from a list of prompts to a list of raw answers, for ``evaluation.judge``.

They hold only plain settings, so Spark can send them to its workers; clients and models are made there, once a process.
"""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from .chat import backoff

Judge = Callable[[list[str]], list[str]]
#: (status, headers in lower case, body) of a POST; raises OSError if nothing was reached.
Post = Callable[[str, dict, bytes, float], tuple[int, dict, bytes]]

#: Answers of a server after which a call is made again, and how often at most.
RETRIED = frozenset({408, 409, 429, 500, 502, 503, 504})
TRIES = 6

SYSTEM = "You compare two answers to a question by the criteria given. Reply with one JSON object and nothing else."


class JudgeError(RuntimeError):
    """A call that trying again can't mend, or whose tries are used up."""


def post(url: str, headers: dict, body: bytes, timeout: float) -> tuple[int, dict, bytes]:
    request = urllib.request.Request(url, body, headers, method="POST")
    try:
        with urllib.request.urlopen(request, timeout=timeout) as got:
            return got.status, {k.lower(): v for k, v in got.headers.items()}, got.read()
    except urllib.error.HTTPError as e:
        return e.code, {k.lower(): v for k, v in e.headers.items()}, e.read()


def _seconds(hint: str | None) -> float:
    """A Retry-After in seconds; a date counts as no hint."""
    try:
        return float(hint or 0)
    except ValueError:
        return 0.0


@dataclass
class ChatJudge:
    """A judge behind a chat-completions endpoint.  The key is read where the call is made, by ``key()``, and never written to a plan."""

    model: str
    url: str
    key: Callable[[], str]
    system: str = SYSTEM
    temperature: float = 0.0
    max_tokens: int = 512
    timeout: float = 60.0
    tries: int = TRIES
    post: Post = post
    sleep: Callable[[float], None] = time.sleep
    jitter: Callable[[], float] = field(default=random.random)

    def __call__(self, prompts: list[str]) -> list[str]:
        return [self.one(p) for p in prompts]

    def one(self, prompt: str) -> str:
        said = [{"role": "system", "content": self.system}, {"role": "user", "content": prompt}]
        body = json.dumps({"model": self.model, "messages": said, "temperature": self.temperature, "max_tokens": self.max_tokens}).encode()
        headers = {"Authorization": f"Bearer {self.key()}", "Content-Type": "application/json"}
        for left in reversed(range(self.tries)):
            hint = None
            try:
                status, got, answer = self.post(f"{self.url.rstrip('/')}/chat/completions", headers, body, self.timeout)
            except OSError as e:
                fault = str(e)
            else:
                if status < 300:
                    return json.loads(answer)["choices"][0]["message"]["content"]
                fault, hint = f"status {status}", got.get("retry-after")
                if status not in RETRIED:
                    break
            if left:
                self.sleep(backoff(self.tries - 1 - left, _seconds(hint), self.jitter()))
        raise JudgeError(fault)


_LOADED: dict = {}


@dataclass
class LocalJudge:
    """A judge that runs on the executor: ``load()`` gives (encode, decode, generate), made once a Python worker.

    Prompts are cut to ``longest`` tokens; ``generate(ids, most)`` gives the new ids only, greedily.
    """

    name: str
    load: Callable[[], tuple[Callable, Callable, Callable]]
    longest: int = 3000
    most: int = 512

    def __call__(self, prompts: list[str]) -> list[str]:
        if self.name not in _LOADED:
            _LOADED[self.name] = self.load()
        encode, decode, generate = _LOADED[self.name]
        return [decode(generate(encode(p)[: self.longest], self.most)) for p in prompts]


def retrying(judge: Judge, readable: Callable[[str | None], bool], again: Callable[[str, int], str] = lambda prompt, k: prompt, retries: int = 2) -> Judge:
    """The judge, asked again for the answers that can't be read, by ``again(prompt, attempt)``; the last answer stands."""

    def ask(prompts: list[str]) -> list[str]:
        answers = [*judge(prompts)]
        for attempt in range(retries):
            bad = [i for i, a in enumerate(answers) if not readable(a)]
            if not bad:
                break
            for i, a in zip(bad, judge([again(prompts[i], attempt) for i in bad])):
                answers[i] = a
        return answers

    return ask
