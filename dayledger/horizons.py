"""Business horizons: how many days must pass before a fact can be judged."""

from __future__ import annotations

from dataclasses import dataclass, field


def _days(hours: int) -> int:
    return -(-hours // 24)


@dataclass(frozen=True)
class Deadlines:
    """Contract terms of an order, in hours or days."""

    payment_hours: int = 24
    shipping_hours: int = 48
    delivery_days: int = 7
    pickup_days: int = 7
    return_days: int = 14
    refund_hours: int = 72


@dataclass(frozen=True)
class Horizons:
    """Cut-offs measured back from the newest order in the data, never from now()."""

    deadlines: Deadlines = field(default_factory=Deadlines)
    customer_maturity_days: int = 30

    @property
    def maturity_days(self) -> int:
        """After this many days no order can change its status any more."""
        d = self.deadlines
        by_hours = sum(map(_days, (d.payment_hours, d.shipping_hours, d.refund_hours)))
        return by_hours + d.delivery_days + d.pickup_days + d.return_days

    @property
    def payment_settlement_days(self) -> int:
        """After this many days it is known whether an order was paid."""
        return _days(self.deadlines.payment_hours) + 1
