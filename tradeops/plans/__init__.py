"""The reports. Each is a function of the input tables and an as-of date."""

from .access_lists import ic_entitlements, login_entitlements, sales_entitlements
from .clients import client_shipments
from .freight_orders import freight_order_view
from .intercompany import ic_accruals, ic_client_side, ic_loans, ic_payments, ic_vendor_side
from .po_lines import po_line_view
from .portal import packing_list_tracker, portal_users
from .sales import gp_contribution
from .sla import country_sla, supplier_sla

REPORTS = {
    ("client analysis", "shipments"): client_shipments,
    ("operations", "country sla"): country_sla,
    ("operations", "supplier sla"): supplier_sla,
    ("operations", "freight orders"): freight_order_view,
    ("operations", "po lines"): po_line_view,
    ("intercompany", "accruals"): ic_accruals,
    ("intercompany", "loans"): ic_loans,
    ("intercompany", "payments"): ic_payments,
    ("intercompany", "client side"): ic_client_side,
    ("intercompany", "vendor side"): ic_vendor_side,
    ("intercompany", "entitlements"): ic_entitlements,
    ("portal", "packing lists"): packing_list_tracker,
    ("portal", "entitlements"): login_entitlements,
    ("portal", "users"): portal_users,
    ("sales", "gross profit"): gp_contribution,
    ("sales", "entitlements"): sales_entitlements,
}
