"""The draws of ``paylens.functions.draws`` as DuckDB SQL; arguments are SQL expressions."""

from __future__ import annotations

from paylens.functions.draws import TRIES

_fresh = iter(range(10**9))


def let(value: str, body) -> str:
    """Evaluate ``value`` once and use it in ``body``."""
    x = f"v{next(_fresh)}"
    return f"list_transform([{value}], lambda {x}: {body(x)})[1]"


def bits(code: str, start: int, digits: int) -> str:
    return f"((('0x' || substr({code}, {start}, {digits}))::BIGINT + 0.5) / {float(16**digits)!r}::DOUBLE)"


def uniform(name: str) -> str:
    return let(f"md5({name})", lambda code: bits(code, 1, 11))


def gamma(name: str, shape: str) -> str:
    def drawn(d: str) -> str:
        def attempt(code: str) -> str:
            normal = f"sqrt(-2.0 * ln({bits(code, 1, 11)})) * cos(2 * pi() * {bits(code, 12, 11)})"
            return let(normal, lambda x: let(f"1 + {x} / sqrt(9.0 * {d})", lambda t: (
                f"CASE WHEN {t} > 0 AND ln({bits(code, 23, 10)}) < 0.5 * {x} * {x} + {d} - {d} * ({t} * {t} * {t}) "
                f"+ {d} * ln(greatest({t} * {t} * {t}, 1e-300)) THEN {d} * ({t} * {t} * {t}) END")))
        j = f"j{next(_fresh)}"
        tries = f"list_transform(range({TRIES}), lambda {j}: {let(f'md5({name} || {chr(39)}|{chr(39)} || {j})', attempt)})"
        g = f"g{next(_fresh)}"
        return f"coalesce(list_filter({tries}, lambda {g}: {g} IS NOT NULL)[1], {d})"
    return let(f"CAST({shape} AS DOUBLE) - 1 / 3.0::DOUBLE", drawn)


def beta(name: str, a: str, b: str) -> str:
    return let(gamma(f"{name} || '|a'", a), lambda x: f"{x} / ({x} + {gamma(f'{name} || {chr(39)}|b{chr(39)}', b)})")
