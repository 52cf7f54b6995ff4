"""Probabilistic automata learned from example strings by merging compatible states of their prefix tree.

Every example is a path in a prefix tree that counts how often a state is passed, left by each symbol, and where
examples end. Going outward from the root, a state is merged with an earlier one if the Hoeffding bound finds no
difference in their end and symbol frequencies, nor in those of their successors; otherwise it becomes a state of its
own. Characters are symbols by class, so that a format is learned rather than its examples.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable, Sequence

END = ""


def symbols(text: str) -> list[str]:
    """Hexadecimal digits and letters, other letters, each by case, and every other character as itself."""
    return [_SYMBOL.get(c, c) for c in text]


_SYMBOL = (
    dict.fromkeys("0123456789", "9")
    | dict.fromkeys("abcdef", "f")
    | dict.fromkeys("ghijklmnopqrstuvwxyz", "z")
    | dict.fromkeys("ABCDEF", "F")
    | dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "Z")
)


class Automaton:
    """A deterministic automaton with a probability for every symbol and for ending, in every state."""

    def __init__(self, steps: list[dict[str, int]], logs: list[dict[str, float]]):
        self.steps, self.logs = steps, logs

    def log_likelihood(self, text: str, unseen: float = math.log(1e-4)) -> float:
        """Natural logarithm of the probability; a symbol without a transition costs ``unseen`` and keeps the state."""
        state, total = 0, 0.0
        for s in symbols(text):
            total += self.logs[state].get(s, unseen)
            state = self.steps[state].get(s, state)
        return total + self.logs[state].get(END, unseen)


def learn(examples: Iterable[str], alpha: float = 0.01) -> Automaton:
    """The automaton of the examples; a smaller ``alpha`` merges more."""
    count, ends, leave, step = [0], [0], [defaultdict(int)], [{}]
    for text in examples:
        state = 0
        for s in symbols(text):
            count[state] += 1
            leave[state][s] += 1
            if s not in step[state]:
                step[state][s] = len(step)
                count.append(0), ends.append(0), leave.append(defaultdict(int)), step.append({})
            state = step[state][s]
        count[state] += 1
        ends[state] += 1
    margin = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(k1: int, n1: int, k2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(k1 / n1 - k2 / n2) > margin * (n1**-0.5 + n2**-0.5)

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if differ(ends[a], count[a], ends[b], count[b]):
                return False
            for s in leave[a].keys() | leave[b].keys():
                if differ(leave[a].get(s, 0), count[a], leave[b].get(s, 0), count[b]):
                    return False
                if s in step[a] and s in step[b]:
                    todo.append((step[a][s], step[b][s]))
        return True

    def fold(a: int, b: int) -> None:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            count[a] += count[b]
            ends[a] += ends[b]
            for s, n in leave[b].items():
                leave[a][s] += n
                if s in step[a]:
                    todo.append((step[a][s], step[b][s]))
                else:
                    step[a][s] = step[b][s]

    own, at = [0], 0
    while at < len(own):  # states reachable from those that are settled, in the order they are met
        state = own[at]
        for s in sorted(step[state]):
            after = step[state][s]
            if after in own:
                continue
            for earlier in own:
                if compatible(earlier, after):
                    step[state][s] = earlier
                    fold(earlier, after)
                    break
            else:
                own.append(after)
                continue
            at = -1  # folding may have given earlier states new successors
            break
        at += 1
    place = {state: i for i, state in enumerate(own)}
    steps = [{s: place[t] for s, t in step[state].items()} for state in own]
    logs = []
    for state in own:
        chances = {s: math.log(n / count[state]) for s, n in leave[state].items()}
        if ends[state]:
            chances[END] = math.log(ends[state] / count[state])
        logs.append(chances)
    return Automaton(steps, logs)


def best(automata: Sequence[Automaton], text: str) -> float:
    return max(a.log_likelihood(text) for a in automata)
