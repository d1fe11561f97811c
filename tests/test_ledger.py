"""Ancestors and last common commits against a walk over random histories."""

from __future__ import annotations

import random

import pytest

from branchyard.operators import ledger as lg


def ancestors(commits, name):
    found, todo = set(), [name]
    while todo:
        commit = todo.pop()
        if commit is not None and commit not in found:
            found.add(commit)
            todo += [commits[commit]["parent"], commits[commit]["parent2"]]
    return found


@pytest.mark.parametrize("seed", range(20))
def test_random_histories(seed):
    rng = random.Random(seed)
    first = lg.new_commit([], "main.0", 0, "start", {})
    commits, authored = {first["hash"]: first}, {("main.0", 0): first["hash"]}
    heads = {"main": {"lane": "main.0", "seq": 0, "commit": first}}
    lives = 0
    for step in range(60):
        ref = rng.choice(list(heads))
        head = heads[ref]
        action = rng.random()
        if action < 0.2 and len(heads) < 6:
            lives += 1
            name = f"r{rng.randrange(4)}x{lives}"
            heads[name] = {"lane": f"{name}.{lives}", "seq": lives, "commit": head["commit"]}
        elif action < 0.25 and ref != "main":
            del heads[ref]
        elif action < 0.5:
            other = heads[rng.choice(list(heads))]["commit"]
            mine = head["commit"]
            head["seq"] += 1
            if lg.includes(mine, other):
                continue
            if lg.includes(other, mine):
                head["commit"] = other
                continue
            head["commit"] = lg.new_commit([mine, other], head["lane"], head["seq"], f"merge {step}", {})
        else:
            head["seq"] += 1
            head["commit"] = lg.new_commit([head["commit"]], head["lane"], head["seq"], f"work {step}", {})
        made = head["commit"]
        if made["hash"] not in commits:
            commits[made["hash"]] = made
            authored[made["lane"], made["pos"]] = made["hash"]
    names = list(commits)
    for a in rng.sample(names, min(15, len(names))):
        for b in rng.sample(names, min(15, len(names))):
            above_a, above_b = ancestors(commits, a), ancestors(commits, b)
            assert lg.includes(commits[a], commits[b]) == (b in above_a)
            base = authored[lg.last_common(commits[a], commits[b])]
            common = above_a & above_b
            assert base in common
            assert commits[base]["depth"] == max(commits[c]["depth"] for c in common)
