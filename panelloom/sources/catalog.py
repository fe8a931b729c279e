"""Layout of the business extracts: one ``SourceSpec`` per dataset.

Directories and file masks are parameters of the installation; preamble lengths, kept and
dropped columns belong to the kind of extract.
"""

from __future__ import annotations

from panelloom.sources.extracts import SourceSpec

CUSTOMER_COLUMNS = ("Account ID", "SAP ID", "Name")
CONTACT_PII = ("Phone", "Mobile", "E-Mail")
REGISTERED_PRODUCT_SUFFIX = "_reg_prod"


def source_specs(root: str, glob: str = "*.csv", delimiter: str = ",") -> dict[str, SourceSpec]:
    """Specs for extracts stored as ``{root}/{dataset}/``."""

    def spec(name: str, preamble: int, **rules) -> SourceSpec:
        return SourceSpec(f"{root}/{name}", glob, preamble=preamble, delimiter=delimiter, **rules)

    return {
        "opportunities": spec("opportunities", 4, recursive=True),
        "quotes": spec("quotes", 4),
        "software_sales": spec("software_sales", 0, tidy_names=True),
        "machine_orders": spec("machine_orders", 0, tidy_names=True),
        "order_headers": spec("order_headers", 0, tidy_names=True),
        "order_partners": spec("order_partners", 0, tidy_names=True),
        "installed_base": spec("installed_base", 2),
        "cases": spec("cases", 2),
        "missions": spec("missions", 2),
        "customers": spec("customers", 4, keep=CUSTOMER_COLUMNS),
        "contacts": spec("contacts", 4, drop=CONTACT_PII),
        "meetings": spec("meetings", 4),
        "mails": spec("mails", 4),
        "other_activities": spec("other_activities", 4),
        "registered_products": spec("registered_products", 4, suffix=REGISTERED_PRODUCT_SUFFIX),
        "survey": spec("survey", 1),
    }
