"""Plain helpers of the tests."""


def union_find(size, links):
    """The least member of each vertex's component."""
    parent = list(range(size))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(size)]
