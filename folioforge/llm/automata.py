"""Probabilistic automata of string formats, inferred by merging states of a prefix tree."""

from __future__ import annotations

import math
import re
from collections import Counter

END = ""
#: Chance of a symbol, or an end, that a state has never seen.
_UNSEEN = 1e-4
#: Where an automaton does not know how a string goes on: chance that the run of a symbol goes on there.
_STAYS = 0.75
_RUN = re.compile(r"[A-Za-z0-9]+")
_HEX = re.compile(r"(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]+")


def shape(value: str) -> str:
    """Each run of letters and digits by what it is made of, at its length; other characters stand for themselves.

    0 digits, a small letters, A capitals, c letters of both cases, h digits and a to f, l digits and
    small letters, U digits and capitals, m digits and letters of both cases.
    """
    return _RUN.sub(lambda m: _kind(m[0]) * len(m[0]), value)


def _kind(run: str) -> str:
    if run.isdigit():
        return "0"
    if run.isalpha():
        return "a" if run.islower() else "A" if run.isupper() else "c"
    if run.islower():
        return "h" if _HEX.fullmatch(run) else "l"
    return "U" if run.isupper() else "m"


def any_string(form: str) -> float:
    """Log likelihood of a format that no automaton knows: its runs, at the price of an unseen symbol."""
    stays = sum(a == b for a, b in zip(form, form[1:]))
    return math.log(_UNSEEN) + stays * math.log(_STAYS) + (len(form) - stays) * math.log(1 - _STAYS)


class Automaton:
    """States with counts of symbols and ends, learned from strings.

    The prefix tree of the strings is folded from the root: each state on the edge of the settled
    ones is merged with the first settled state whose frequencies, and those of all states behind
    it, are compatible with its own by Hoeffding's bound at `alpha`; else it is settled itself.
    """

    def __init__(self, strings: list[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[Counter] = [Counter()]
        for text in sorted(strings):
            state = 0
            for symbol in text:
                self.seen[state][symbol] += 1
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.next.append({})
                    self.seen.append(Counter())
                state = self.next[state][symbol]
            self.seen[state][END] += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._fold()
        self._logs = [
            {s: math.log((1 - _UNSEEN) * c / max(1, total)) for s, c in seen.items()}
            for seen in self.seen
            for total in [sum(seen.values())]
        ]

    def _alike(self, a: int, b: int) -> bool:
        """No frequency of the two states, or of those that follow both, differs beyond the bound."""
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            n, m = sum(self.seen[a].values()), sum(self.seen[b].values())
            if not n or not m:
                continue
            most = self._bound * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if most < 1:  # else no two frequencies differ by more
                symbols = self.seen[a].keys() | self.seen[b].keys()
                if any(abs(self.seen[a][s] / n - self.seen[b][s] / m) > most for s in symbols):
                    return False
            pending += [(self.next[a][s], t) for s, t in self.next[b].items() if s in self.next[a] and self.next[a][s] != t]
        return True

    def _merge(self, a: int, b: int) -> None:
        """Fold the tree under b into a."""
        pending = [(a, b)]
        while pending:
            a, b = pending.pop()
            self.seen[a].update(self.seen[b])
            for symbol, state in self.next[b].items():
                if symbol in self.next[a]:
                    pending.append((self.next[a][symbol], state))
                else:
                    self.next[a][symbol] = state

    def _fold(self) -> None:
        settled = [0]
        while True:
            kept = set(settled)
            edge = [(s, x, t) for s in settled for x, t in sorted(self.next[s].items()) if t not in kept]
            if not edge:
                break
            state, symbol, new = max(edge, key=lambda e: (sum(self.seen[e[2]].values()), -e[2]))
            match = next((old for old in settled if self._alike(old, new)), None)
            if match is None:
                settled.append(new)
            else:
                self.next[state][symbol] = match
                self._merge(match, new)
        self.states = len(settled)

    def log_likelihood(self, text: str) -> float:
        """Of the string under the automaton; from where it leaves the known states, of any string's runs."""
        total, state, rare = 0.0, 0, math.log(_UNSEEN)
        for i, symbol in enumerate(text):
            if symbol not in self.next[state]:
                return total + any_string(text[i:])
            total += self._logs[state].get(symbol, rare)
            state = self.next[state][symbol]
        return total + self._logs[state].get(END, rare)
