"""Query registry, and the models composed over one folder of tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.plans import analytics, commercial, finance, marketing, product
from martwright.plans.staging import STAGING
from martwright.session import require_ansi
from martwright.sources.footers import footer_table
from martwright.sources.proxies import ABSENT, generated_source
from martwright.sources.store import MartStore, code_digest, snapshot_id
from martwright.functions import strip_prefix


@dataclass(frozen=True)
class Case:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


CASES: dict[str, Case] = {}


def case(name: str, sql: str | None = None):
    """Register a query over a ``Domain`` under a name."""

    def register(build: Callable[[Domain], DataFrame]):
        CASES[name] = Case(name, lambda spark, folder: build(registered_domain(spark, folder)), sql)
        return build

    return register


class Domain:
    """All models over one folder of raw tables, composed lazily from the scans up.

    ``snapshot`` names the state of the tables, such as a table version: stored marts of one snapshot
    are reused without listing the source files.
    """

    def __init__(self, spark: SparkSession, folder: str, snapshot: str | None = None):
        require_ansi(spark)
        self.spark = spark
        self.folder = folder
        self.snapshot = snapshot
        self._marts: Published | None = None

    def raw(self, name: str) -> DataFrame:
        return generated_source(self.spark, self.folder, name)

    def table(self, name: str) -> DataFrame:
        """A table as it lies in the folder, without declared schema."""
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def footers(self, name: str) -> DataFrame:
        """The same table, read so that counts come from its files' footers."""
        return footer_table(self.spark, f"{self.folder}/{name}.parquet")

    def staged(self, name: str) -> DataFrame:
        return STAGING[name](self.raw(name))

    def staged_present(self, name: str) -> DataFrame:
        """The staged table without the columns the generated data has no values for."""
        return self.staged(name).drop(*map(strip_prefix, ABSENT[name]))

    def orders(self) -> DataFrame:
        return commercial.stg_commercial__orders(self.staged("orders"))

    def customers(self) -> DataFrame:
        return commercial.stg_commercial__customers(self.staged("customer"))

    def lineitems(self) -> DataFrame:
        return commercial.stg_commercial__lineitems(self.staged("lineitem"))

    def order_items(self) -> DataFrame:
        return commercial.int_order_items(self.orders(), self.lineitems())

    def rollup(self) -> DataFrame:
        return commercial.order_rollup(self.orders(), self.staged("lineitem"))

    def fct_orders(self) -> DataFrame:
        return commercial.fct_orders_v1(self.rollup())

    def dim_customers(self) -> DataFrame:
        history = commercial.int_customer_orders(self.rollup())
        return commercial.dim_customers_v1(self.customers(), history)

    def finance_orders(self) -> DataFrame:
        """Finance reads the stored contract of the order fact, not the raw lines."""
        return finance.stg_finance__orders(self.published().fct_orders())

    def fct_revenue(self) -> DataFrame:
        return finance.fct_revenue_v1(self.finance_orders())

    def marketing_customers(self) -> DataFrame:
        """Marketing reads the stored contract of the customer mart."""
        return marketing.stg_marketing__customers(self.published().dim_customers())

    def fct_attribution(self) -> DataFrame:
        return marketing.fct_attribution_v1(self.marketing_customers())

    def usage(self) -> DataFrame:
        return product.stg_product__usage(self.staged("lineitem"))

    def fct_usage(self) -> DataFrame:
        return product.fct_usage_v1(product.stg_product__usage(self.staged("lineitem")))

    def source_state(self) -> str:
        """The caller's snapshot id, or else a digest of name, size and change time of every source
        file; lists them, reads none."""
        if self.snapshot is not None:
            return self.snapshot
        paths = [f"{self.folder}/{t}.parquet" for t in ("customer", "lineitem", "orders")]
        files = self.spark.read.format("binaryFile").load(paths)
        file = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
        return str(tuple(files.agg(F.expr("count(*)"), F.sum(file)).first()))

    def published(self) -> Published:
        """Marts stored as catalog tables: built on first use, read from then on, by other sessions and
        applications too, and built anew when the source files or the models' code change."""
        if self._marts is None:
            state = snapshot_id(self.folder, self.source_state(), code_digest())
            self._marts = Published(self, MartStore(self.spark, state))
        return self._marts


_STATES: dict[tuple[str, str], str] = {}


def registered_domain(spark: SparkSession, folder: str) -> Domain:
    """A domain for a registered query. Its folders hold fixed tables, so their files are listed once per
    application; ``Domain`` itself lists them each time."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STATES:
        _STATES[key] = Domain(spark, folder).source_state()
    return Domain(spark, folder, _STATES[key])


def build_marts(d: Domain) -> list[str]:
    """Builds whatever published mart is not there yet; the names of the tables."""
    marts = d.published()
    for build in (marts.fct_orders, marts.dim_customers, marts.fct_revenue, marts.fct_attribution,
                  marts.fct_usage, marts.enriched, marts.partsupp):
        build()
    return [marts.store.table_of(*key) for key in marts.used]


class Published:
    """Stored marts, each built from the stored tables above it and read at a pinned version.

    The order rollup is stored as well: lines are scanned and shuffled once for the order fact, the
    customer history and everything downstream of either.
    """

    def __init__(self, domain: Domain, store: MartStore):
        self.domain = domain
        self.store = store
        self.used: list[tuple[str, int | None]] = []

    def _stored(
        self,
        name: str,
        version: int | None,
        build: Callable[[], DataFrame],
        sort_by: str | None = None,
    ) -> DataFrame:
        if (name, version) not in self.used:
            self.used.append((name, version))
        return self.store.publish(name, version, build, sort_by)

    def rollup(self) -> DataFrame:
        return self._stored("order_rollup", None, self.domain.rollup)

    def partsupp(self) -> DataFrame:
        """The stand-in is a shuffle of all lines, done once for all its checks."""
        return self._stored("stg_partsupp", None, lambda: self.domain.staged_present("partsupp"))

    def fct_orders(self, version: int = 1) -> DataFrame:
        shape = {1: commercial.fct_orders_v1, 2: commercial.fct_orders_v2}[version]
        return self._stored("fct_orders", version, lambda: shape(self.rollup()))

    def dim_customers(self) -> DataFrame:
        def build():
            history = commercial.int_customer_orders(self.rollup())
            return commercial.dim_customers_v1(self.domain.customers(), history)

        return self._stored("dim_customers", 1, build)

    def fct_revenue(self) -> DataFrame:
        def build():
            return finance.fct_revenue_v1(finance.stg_finance__orders(self.fct_orders()))

        return self._stored("fct_revenue", 1, build)

    def fct_attribution(self) -> DataFrame:
        def build():
            customers = marketing.stg_marketing__customers(self.dim_customers())
            return marketing.fct_attribution_v1(customers)

        return self._stored("fct_attribution", 1, build)

    def fct_usage(self) -> DataFrame:
        return self._stored("fct_usage", 1, self.domain.fct_usage)

    def enriched(self) -> DataFrame:
        def build():
            return analytics.fct_orders_enriched(self.fct_orders(), self.dim_customers())

        return self._stored("fct_orders_enriched", None, build, sort_by="order_date")
