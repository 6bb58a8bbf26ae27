"""Column functions whose results do not depend on the engine's defaults."""

from .scalars import cosine, dot, exact_avg, exact_sum, half_up, money, weekday  # noqa: F401
