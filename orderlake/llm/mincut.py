"""The cheapest labelling of a small graph: two labels, a cost per node and label, a cost per edge that is cut."""

from collections import deque


def cheapest_labels(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """`gains[i]` is what label True saves over False at node i (may be negative); an edge (i, j, c) costs c if its
    ends differ. Returns the labels of least total cost, of several such the one with the fewest True.

    It is a minimum cut: positive gains are capacities from the source, negative ones to the sink. Nodes whose own
    gain outweighs all their edges are settled first, and each settles its neighbours' edges in turn; what is left is
    solved by maximum flow along shortest paths.
    """
    count = len(gains)
    around: list[list[tuple[int, int]]] = [[] for _ in range(count)]
    for i, j, c in edges:
        if i != j and c > 0:
            around[i].append((j, c))
            around[j].append((i, c))
    gain, free = list(gains), [sum(c for _, c in near) for near in around]
    labels: list[bool | None] = [None] * count
    waiting = deque(range(count))
    while waiting:
        i = waiting.popleft()
        if labels[i] is not None:
            continue
        if gain[i] > free[i]:
            labels[i] = True
        elif -gain[i] >= free[i]:
            labels[i] = False
        else:
            continue
        for j, c in around[i]:
            if labels[j] is None:
                gain[j] += c if labels[i] else -c
                free[j] -= c
                waiting.append(j)
    rest = [i for i in range(count) if labels[i] is None]
    if rest:
        place = {i: k for k, i in enumerate(rest)}
        inner = [(place[i], place[j], c) for i in rest for j, c in around[i] if i < j and labels[j] is None]
        for k, label in enumerate(source_side([gain[i] for i in rest], inner)):
            labels[rest[k]] = label
    return labels


def source_side(gains: list[int], edges: list[tuple[int, int, int]]) -> list[bool]:
    """The nodes that the source still reaches when the flow is at its maximum."""
    count = len(gains)
    source, sink = count, count + 1
    heads: list[list[int]] = [[] for _ in range(count + 2)]
    to, left = [], []

    def connect(a, b, there, back):
        heads[a].append(len(to))
        to.append(b)
        left.append(there)
        heads[b].append(len(to))
        to.append(a)
        left.append(back)

    for i, gain in enumerate(gains):
        if gain > 0:
            connect(source, i, gain, 0)
        elif gain < 0:
            connect(i, sink, -gain, 0)
    for i, j, c in edges:
        connect(i, j, c, c)

    while True:
        level = [-1] * (count + 2)
        level[source] = 0
        waiting = deque([source])
        while waiting:
            a = waiting.popleft()
            for e in heads[a]:
                if left[e] > 0 and level[to[e]] < 0:
                    level[to[e]] = level[a] + 1
                    waiting.append(to[e])
        if level[sink] < 0:
            return [level[i] >= 0 for i in range(count)]
        following = [0] * (count + 2)
        path: list[int] = []
        a = source
        while True:
            if a == sink:
                flow = min(left[e] for e in path)
                cut = None
                for k, e in enumerate(path):
                    left[e] -= flow
                    left[e ^ 1] += flow
                    if cut is None and not left[e]:
                        cut = k
                # Go on from before the first edge that is full.
                a = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while following[a] < len(heads[a]):
                e = heads[a][following[a]]
                if left[e] > 0 and level[to[e]] == level[a] + 1:
                    break
                following[a] += 1
            if following[a] < len(heads[a]):
                path.append(e)
                a = to[e]
            elif path:
                level[a] = -1
                a = to[path.pop() ^ 1]
            else:
                break
