"""Settings shared by all marts."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Config:
    """Values a deployment chooses.

    ``org`` is the spelling of the company's own name inside CRM column names
    (``<org>_contact__c``, ``why_<org>``).  With ``org`` set, the published columns carry it
    too; without it they carry neutral names.  ``quote_tie`` is the column deciding between
    quote versions of equal age; by default a digest of the row decides.  With ``guard_lookups`` a build
    fails when a lookup key occurs twice, which would multiply rows.  With ``set_aside`` raw registrations with an
    unreadable time do not fail the build: they are left out, and stored apart with the reason where there is a store.
    """

    org: str | None = None
    internal_domain: str = "corp.example"
    manager_levels: int = 7
    product_logic_version: str = "product_conform_v1"
    as_of: datetime | None = None
    lenient_times: bool = False
    quote_tie: str | None = None
    guard_lookups: bool = False
    set_aside: bool = False

    @property
    def org_prefix(self) -> str:
        return self.org or "internal"

    @property
    def employee_flag(self) -> str:
        return f"is_{self.org}_employee" if self.org else "is_internal_user"

    @property
    def why_us(self) -> str:
        return f"why_{self.org}" if self.org else "why_us"

    def spell(self, text: str) -> str:
        """Fill the company-specific column names of a field list."""
        return text.format(org=self.org_prefix, why_us=self.why_us, employee=self.employee_flag)

    def load_time(self) -> Column:
        """Load timestamp stamped on published rows; fixed when ``as_of`` is given."""
        if self.as_of is None:
            return F.current_timestamp()
        return F.lit(self.as_of.isoformat(sep=" ")).cast("timestamp")
