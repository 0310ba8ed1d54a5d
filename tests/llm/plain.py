"""Plain versions that tests compare with."""


def targets(sizes, weights=(5.0, 2.0, 1.0), times=3):
    """Shares by weight; what is above ``times`` a size goes to the others, until none is."""
    out, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        unit = left / sum(weights[i % len(weights)] for i in open_)
        above = {i for i in open_ if unit * weights[i % len(weights)] > times * sizes[i]}
        for i in above or open_:
            out[i] = float(times * sizes[i]) if above else unit * weights[i % len(weights)]
        left -= sum(times * sizes[i] for i in above)
        open_ = open_ - above if above else set()
    return out
