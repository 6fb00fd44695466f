"""Plain loops that the operators are compared with."""

import math


def windows(tokens, size, stride):
    """(input, target) of all windows of size + 1 tokens; stops at the first one that reaches the end."""
    out, start = [], 0
    while start < len(tokens):
        window = tokens[start : start + size + 1]
        out.append((window[:-1], window[-1]))
        if start + size + 1 >= len(tokens):
            break
        start += stride
    return out


def positional(size, dim, mode):
    flat = [0.0] * (size * dim)
    for position in range(size):
        for place in range(dim):
            even = place - place % 2
            exponent = (2 * even if mode == "reference" else even) / dim
            angle = position / 10000**exponent
            index = position + place if mode == "reference" else position * dim + place
            flat[index] = math.cos(angle) if place % 2 else math.sin(angle)
    return flat


def token_frame(spark, lists, element="string"):
    rows = [(key, tokens) for key, tokens in enumerate(lists)]
    return spark.createDataFrame(rows, f"doc_id long, tokens array<{element}>")
