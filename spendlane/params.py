"""Run parameters of the spend report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

MASTER = "MASTER"


@dataclass(frozen=True)
class ReportParams:
    """Arguments of one report run; ``None`` means no restriction.

    ``client_type``: ``"MASTER"`` scopes on the master client number; any other
    value scopes on the GCI.  ``client_ids``: the accepted numbers; an empty
    tuple is an error, since it can only give an empty report.
    ``start``/``end``: inclusive invoice date range, each end on its own.
    ``variant``: ``"canonical"`` or ``"port_country"`` (leg countries from the
    ports and the merged delivery/destination charge category).
    ``invoice_numbers``: optional spot-check scope;
    ``scope_export_references`` and ``scope_final`` say where besides the lines
    and legs the scope is applied.
    ``stacked_roles``: dimensions (``"party_clients"``, ``"branches"``, ``"ports"``) too
    large to broadcast, whose roles in a leg are found by one lookup instead of a
    join each; the rows are the same.
    """

    client_type: str = MASTER
    client_ids: tuple[str, ...] | None = None
    start: dt.date | None = None
    end: dt.date | None = None
    variant: str = "canonical"
    invoice_numbers: tuple[str, ...] | None = None
    scope_export_references: bool = True
    scope_final: bool = True
    stacked_roles: tuple[str, ...] = ()

    def __post_init__(self):
        if self.variant not in ("canonical", "port_country"):
            raise ValueError(f"unknown variant {self.variant!r}")
        unknown = set(self.stacked_roles) - {"party_clients", "branches", "ports"}
        if unknown:
            raise ValueError(f"no such roles: {sorted(unknown)}")
        for name in ("client_ids", "invoice_numbers"):
            given = getattr(self, name)
            if given is not None:
                object.__setattr__(self, name, tuple(given))
                if not given:
                    raise ValueError(f"{name} is empty; use None for no restriction")

    @property
    def by_master(self) -> bool:
        return self.client_type == MASTER

    @property
    def scoped(self) -> bool:
        """Whether the run is restricted to some clients or invoices."""
        return self.client_ids is not None or self.invoice_numbers is not None

    @property
    def merged_charges(self) -> bool:
        return self.variant == "port_country"

    @property
    def port_countries(self) -> bool:
        return self.variant == "port_country"
