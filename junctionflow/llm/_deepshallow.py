"""Deep-shallow order of byte strings: multikey quicksort, then blind tries."""

from __future__ import annotations

#: Bytes that multikey quicksort compares at a time, and the depth at which blind tries take over.
STEP, SHALLOW = 4, 16


def common_prefix(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (x.bit_length() + 7) // 8


class _Node:
    __slots__ = ("depth", "down", "here")

    def __init__(self, depth: int):
        self.depth, self.down, self.here = depth, {}, []


def blind_trie_order(strings: list[bytes], members: list[int]) -> list[int]:
    """members in the order of their strings.

    An inner node knows only how long its strings' common prefix is and the byte
    that follows it on each branch. A new string follows these bytes blindly to
    some leaf, one comparison with that leaf gives the true common prefix, and
    the string is hung in there.
    """
    first = _Node(len(strings[members[0]]))
    first.here.append(members[0])
    root = first
    for m in members[1:]:
        s = strings[m]
        node = root
        while node.down:
            below = node.down.get(s[node.depth]) if node.depth < len(s) else None
            if below is None and node.here:
                break
            node = below or next(iter(node.down.values()))
        shared = common_prefix(s, strings[node.here[0]])
        above, node = None, root
        while node.depth < shared:
            above, node = node, node.down[s[node.depth]]
        if node.depth > shared:  # split the way to node
            fork = _Node(shared)
            some = node
            while not some.here:
                some = next(iter(some.down.values()))
            fork.down[strings[some.here[0]][shared]] = node
            if above is None:
                root = fork
            else:
                above.down[s[above.depth]] = fork
            node = fork
        if len(s) == shared:
            node.here.append(m)
        elif s[shared] in node.down:
            raise AssertionError("a blind search ends at the longest common prefix")
        else:
            leaf = _Node(len(s))
            leaf.here.append(m)
            node.down[s[shared]] = leaf
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out += node.here
        todo += [node.down[b] for b in sorted(node.down, reverse=True)]
    return out


def deep_shallow_order(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Indexes of strings in their order; equal strings in the order given."""
    out: list[int] = []
    todo: list[tuple[list[int], int]] = [(list(range(len(strings))), 0)]
    while todo:
        members, d = todo.pop()
        if len(members) < 2:
            out += members
        elif d >= shallow:
            out += blind_trie_order(strings, members)
        else:
            pivot = strings[members[len(members) // 2]][d : d + STEP]
            less, same, more = [], [], []
            for m in members:
                key = strings[m][d : d + STEP]
                (same if key == pivot else less if key < pivot else more).append(m)
            if more:
                todo.append((more, d))
            if len(pivot) < STEP:  # the strings end here and are equal
                todo += [([m], d) for m in reversed(same)]
            else:
                todo.append((same, d + STEP))
            if less:
                todo.append((less, d))
    return out
