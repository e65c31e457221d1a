"""Shared inputs of one report run: the views, the parameters, and the
dimension DataFrames every leg joins (built once so the legs share plans)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlane.operators.joins import Role, join_roles
from spendlane.operators.scope import client_scope, client_scope_column, date_scope, invoice_scope, table_scope
from spendlane.params import ReportParams
from spendlane.shared import written
from spendlane.sources.named import NamedViews
from spendlane.sources.views import Views

CLIENT_ROLE_COLUMNS = ("gci_name", "gci_addr_line1", "gci_addr_line2", "gci_state", "gci_city")
BRANCH_ROLE_COLUMNS = ("branch_code", "country_name", "region_code_1")
PORT_ROLE_COLUMNS = ("port_code", "country_name")
PARTIES = "party_clients"


def leg_roles(origin: str, destination: str, shipper: str, consignee: str, ports: tuple[str, str],
              port_prefixes: tuple[str, str]) -> tuple[Role, ...]:
    """The branches, parties and ports of a leg, by the names of its fact's keys."""
    return (
        Role("bo_", "branches", "branch_key", origin, BRANCH_ROLE_COLUMNS),
        Role("bd_", "branches", "branch_key", destination, BRANCH_ROLE_COLUMNS),
        Role("sh_", PARTIES, "client_key", shipper, CLIENT_ROLE_COLUMNS),
        Role("cn_", PARTIES, "client_key", consignee, CLIENT_ROLE_COLUMNS),
        Role(port_prefixes[0], "ports", "port_key", ports[0], PORT_ROLE_COLUMNS),
        Role(port_prefixes[1], "ports", "port_key", ports[1], PORT_ROLE_COLUMNS),
    )


class ReportContext:
    """``clients`` and ``invoices``: scopes given as tables of one column (client or
    master numbers by the run's client type; invoice numbers) instead of the lists of
    ``params``; they may hold any number of ids."""

    def __init__(self, views: Views | NamedViews, params: ReportParams, clients: DataFrame | None = None,
                 invoices: DataFrame | None = None):
        if clients is not None and params.client_ids is not None:
            raise ValueError("clients are given both as a list and as a table")
        if invoices is not None and params.invoice_numbers is not None:
            raise ValueError("invoices are given both as a list and as a table")
        self.views = views
        self.params = params
        self.clients = clients
        self.invoices = invoices
        self._memo: dict[str, DataFrame] = {}

    def memo(self, key: str, build) -> DataFrame:
        """Build a shared intermediate once per run, so every use is the same
        plan and Spark reuses its exchanges."""
        if key not in self._memo:
            self._memo[key] = build()
        return self._memo[key]

    def with_parties(self, facts: DataFrame, roles: tuple[Role, ...]) -> DataFrame:
        """``facts`` joined to the clients among ``roles``, a table of any size."""
        return self._with_roles(facts, [r for r in roles if r.dimension == PARTIES])

    def with_places(self, facts: DataFrame, roles: tuple[Role, ...]) -> DataFrame:
        """``facts`` joined to the branches and ports of ``roles``, which are broadcast: best
        after the facts have met all they move for, as their texts then never travel."""
        return self._with_roles(facts, [r for r in roles if r.dimension != PARTIES])

    def _with_roles(self, facts: DataFrame, roles: list[Role]) -> DataFrame:
        return join_roles(facts, roles, lambda name: getattr(self, name), self.params.stacked_roles)

    def chosen(self, df: DataFrame) -> DataFrame:
        """``df``, which holds rows of the run's invoices only, as a side of a join: a few
        rows if the run lists its invoices, else any number."""
        return F.broadcast(df) if self.params.invoice_numbers is not None else df

    @classmethod
    def from_dir(cls, spark: SparkSession, base_dir: str, params: ReportParams) -> "ReportContext":
        """Context over the views derived from the tables of ``base_dir``."""
        return cls(Views(spark, base_dir), params)

    @property
    def spark(self) -> SparkSession:
        return self.views.spark

    @property
    def scoped(self) -> bool:
        """Whether the run is restricted to some clients or invoices."""
        return self.params.scoped or self.clients is not None or self.invoices is not None

    @property
    def scopes_clients(self) -> bool:
        return self.params.client_ids is not None or self.clients is not None

    @property
    def scopes_dates(self) -> bool:
        return self.params.start is not None or self.params.end is not None

    @property
    def scopes_invoices(self) -> bool:
        return self.params.invoice_numbers is not None or self.invoices is not None

    def in_invoice_scope(self, df: DataFrame, col: str) -> DataFrame:
        """Rows of the invoices that the run names, by list or by table."""
        if self.invoices is not None:
            return table_scope(df, col, self.invoices)
        return invoice_scope(df, col, self.params)

    @cached_property
    def scoped_clients(self) -> DataFrame:
        """Clients in scope, projected to what the legs read.

        A scope given as a table is looked up once and written, so that the facts
        join a small stored selection, which can prune their scans at run time."""
        cols = ["client_key", "gci", "gci_name", "master_client_number", "master_client_name",
                "usage_distinction_type"]
        if self.clients is None:
            return client_scope(self.views.client_dimension, self.params).select(*cols)
        chosen = table_scope(self.views.client_dimension, client_scope_column(self.params), self.clients)
        least = -(1 << 63)  # of a key: holds for all, and marks a selection as in table_scope
        return written(chosen.select(*cols), "clients-in-scope").filter(F.col("client_key") >= F.lit(least))

    @cached_property
    def party_clients(self) -> DataFrame:
        """All clients, in the shape the shipper / consignee roles read (not
        scoped: any client can be a party)."""
        return self.views.client_dimension.select("client_key", *CLIENT_ROLE_COLUMNS)

    @cached_property
    def billing(self) -> DataFrame:
        return self.views.billing_dimension

    # dimensions of a calendar or a list of codes: their size does not follow the
    # facts, which would otherwise be shuffled by a few keys to meet them
    @cached_property
    def dates(self) -> DataFrame:
        return F.broadcast(date_scope(self.views.date_dimension, "date", self.params))

    @cached_property
    def rates(self) -> DataFrame:
        return F.broadcast(self.views.currency_exchange_dimension)

    @cached_property
    def currencies(self) -> DataFrame:
        return F.broadcast(self.views.currency_dimension)

    @cached_property
    def branches(self) -> DataFrame:
        return F.broadcast(self.views.branch_dimension)

    @cached_property
    def ports(self) -> DataFrame:
        return F.broadcast(self.views.port_dimension)

    @cached_property
    def service_levels(self) -> DataFrame:
        return F.broadcast(self.views.service_level_dimension)

    @cached_property
    def service_types(self) -> DataFrame:
        return F.broadcast(self.views.service_type_dimension)
