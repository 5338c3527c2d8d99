"""The reports. Each takes DataFrames and a run date and returns a DataFrame, or a dict of them."""

from .agent_fact import agency_agents, agent_list, coverage_fact, plan_margins  # noqa: F401
from .agent_pack import (  # noqa: F401
    advice,
    agent_kpis,
    agent_partials,
    kpis_from_partials,
    agent_overview,
    agent_page1,
    agent_page2,
    agent_ratios,
    claim_kpis,
    lapse_risks,
    next_leads,
    policy_facts,
    premium_rank,
    qualification,
    retention,
    sales_mix,
    title_dates,
    top_policies,
)
from .agents import (  # noqa: F401
    active_agents,
    agent_contacts,
    agent_hierarchy,
    campaign_agents,
    course_completions,
    first_exams,
)
from .claims import claim_turnaround, weekly_ops  # noqa: F401
from .customers import (  # noqa: F401
    agent_campaign,
    app_customers,
    app_registrations,
    app_users,
    bank_customers,
    customer_holdings,
    customer_month,
    customer_profile,
    insured_policies,
    monthly_app_premium,
    servicing_status,
    top_campaign_agents,
)
from .kpis import bank_kpis, company_kpis, product_group, product_groups  # noqa: F401
from .leads import attribute_leads, clean_leads, contact_entries, lead_history  # noqa: F401
from .ledger import (  # noqa: F401
    account_balance,
    collections,
    ledger_summary,
    net_pickups,
    payment_reconciliation,
)
from .movement import bucket_labels, status_movement  # noqa: F401
from .sales import (  # noqa: F401
    commission,
    ecommerce_enrich,
    ecommerce_sales,
    first_submissions,
    first_year_premium,
    margin_for,
    new_business_value,
    sales_report,
    submissions,
)
from .service import (  # noqa: F401
    campaign_tracking,
    dropped_policies,
    mask_columns,
    medical_exams,
    not_taken,
    sms_report,
    welcome_calls,
)
