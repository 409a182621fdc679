"""Column contracts: raw columns read and published columns, in order.

Notation: ``name``, ``name:kind`` or ``name:kind<source`` (see ``operators.conform``).
``{org}``, ``{employee}`` and ``{why_us}`` are filled from the configuration.
"""

from __future__ import annotations

from revmart.config import Config
from revmart.operators.conform import Field, parse_fields

# ---------------------------------------------------------------------------------------
# Column names of the CRM extracts and of the published tables.
# ---------------------------------------------------------------------------------------

LEGACY_STAGING = """
deal_registration_id<id channel_account_manager_id created_by_id<createdbyid current_user_id
distributor_account_id distributor_rep_id {org}_contact_id last_modified_by_id<lastmodifiedbyid lead_id
opportunity_id owner_id<ownerid partner_account_id partner_sales_rep_id preferred_distributor_id
rd_manager_for_approvals_id x18_digit_deal_registration_id<x18_digit_deal_registration_id__c
x18_digit_owner_id<x18_digit_owner_id__c add_teaming_partner:flag am_approved:flag am_rejected:flag
approved_date:time atgexternal_id<atgexternalid__c business_justification_for_decline champion_business_title
champion_contact_email champion_contact_first_name champion_contact_last_name champion_contact_phone company
created_date:time<createddate currency_iso_code<currencyisocode days_since_approval deal_reg_comments
deal_registration_extension_approval deal_registration_type dealreg_extension_partner_justification
decline_reason denied_party_screening_status eligible_for_resubmission:flag expected_close_date:time
expected_opportunity_amount expiration_date:time {org}_contact_mailto is_clone:flag is_deleted:flag<isdeleted
is_resubmitted:flag<resubmitted__c is_there_a_budget_defined last_activity_date:time<lastactivitydate
last_modified_date:time<lastmodifieddate last_referenced_date:time<lastreferenceddate
last_viewed_date:time<lastvieweddate lead_owner_email deal_registration_name<name opportunity_owner
opportunity_owner_rd partner_agrees_to_set_up_meeting:flag partner_met_or_spoken_with_a_customer:flag
partner_support_comments products_of_interest<product_s_of_interest__c project_driver
reprocess_notifications_distributor:flag reseller_company_name reseller_sales_rep_name resubmission_comments
system_mod_stamp:time<systemmodstamp teaming_request_status value_adds
"""

PORTAL_STAGING = """
vartopia_registration_id<id created_by_id<createdbyid distributor_contact_id<distributor_contact__c
partner_manager_2_id<{org}_partner_manager_2__c last_modified_by_id<lastmodifiedbyid owner_id<ownerid
rd_manager_id<rd_manager__c child_registration_id customer_account_id<vartopiadrs__customer__c
customer_account_owner_id<vartopiadrs__customer_account_ownerid__c customer_contact_id distributor_account_id
lead_id mdf_campaign_id opportunity_id opportunity_owner_id<vartopiadrs__opportunity_ownerid__c
partner_account_id partner_manager_id partner_se_contact_id
primary_registration_id<vartopiadrs__primary_registration1__c
prospect_contact_id<vartopiadrs__prospect_contact_id__c sales_rep_id salesrep_contact_id submitter_contact_id
am_vartopia_record_id<vartopiadrs__am_vartopia_record_id__c
vartopia_sf_registration_id<vartopiadrs__vartopia_registration_id__c
vendor_approval_id<vartopiadrs__vendor_approval_id__c vendor_deal_id<vartopiadrs__vendor_deal_id__c
is_deleted:flag<isdeleted is_clone:flag<is_clone__c is_approved_by_vartopia:flag is_created_by_auto_reg:flag
is_created_from_mvs:flag is_created_from_registration:flag is_ez_update_eligible:flag
is_registration_extended:flag is_registration_sent_to_vartopia:flag is_send_update_request:flag
is_sent_to_vartopia:flag is_sync_with_vartopia:flag<vartopiadrs__sync_registration_with_vartopia__c
business_justification:text<business_justification__c default_account_source:text<default_account_source__c
default_account_type:text<default_account_type__c default_opp_stage:text<default_opp_stage__c
dr_type_validation:text<dr_type_validation__c contact_geo:text<{org}_contact_geo__c
internal_notes:text<internal_notes__c legacy_dr_id:text<legacy_dr_id__c
reminder_emails:text<reminder_emails__c active_customer_registrations
am_campaign_id<vartopiadrs__am_campaign_id__c am_incentive_amount am_incentive_type:text am_program_name:text
am_vendor_unique_id:text<vartopiadrs__am_vendor_unique_id__c approved_date:time comments:text
customer_address_line1:text<vartopiadrs__customer_addressline1__c
customer_address_line2:text<vartopiadrs__customer_addressline2__c customer_city:text
customer_contact_email:text<vartopiadrs__customer_contact_email_new__c customer_contact_first_name:text
customer_contact_job_title:text customer_contact_last_name:text customer_contact_phone:text
customer_country:text customer_country_state:text customer_industry:text customer_name:text
customer_state:text customer_website:text customer_zip:text current_date_time:time days_to_approve
days_since_approval<days_since_approval__c days_to_denied days_to_progress deal_name:text denial_reason:text
domain:text error_message:text expected_close_date:time expected_revenue expiration_date:time
extension_status:text lead_source:text last_request_for_update:time last_update_provided_by_partner:time
last_updated_for_vartopia:time deal_registration_name:text<name next_update_auto_request_date:time
no_of_attempts approved_regs_count<vartopiadrs__of_approved_regs__c
approved_regs_partner_rep_count<vartopiadrs__of_approved_regs_partner_rep__c
closed_won_partner_rep_count<vartopiadrs__of_closed_won_partner_rep__c
closed_won_regs_count<vartopiadrs__of_closed_won_regs__c opportunity_amount
opportunity_stage_name:text<vartopiadrs__opportunity_stagename__c partner_notes:text partner_se_email:text
partner_se_first_name:text<vartopiadrs__partner_se_firstname__c
partner_se_last_name:text<vartopiadrs__partner_se_lastname__c
partner_se_phone:text<vartopiadrs__partner_se_phonenumber__c partner_status:text
primary_salesrep_email:text<vartopiadrs__primary_salesrep_email_new__c
primary_salesrep_first_name:text<vartopiadrs__primary_salesrep_firstname__c
primary_salesrep_last_name:text<vartopiadrs__primary_salesrep_lastname__c primary_salesrep_phone:text
program_name:text reg_auto_sync_time:time reg_days_since_submitted reg_denied_date:time
registration_lot_number registration_url:text request_sent_count<vartopiadrs__request_sent__c
solution_name:text submitted_by_email:text<vartopiadrs__submitted_by_email_new__c
submitted_by_first_name:text<vartopiadrs__submitted_by_firstname__c
submitted_by_last_name:text<vartopiadrs__submitted_by_lastname__c
submitted_by_phone:text<vartopiadrs__submitted_by_phonenumber__c submitter_type:text time_to_approve:time
true_source:text updates_received_from_partner vendor_status:text currency_iso_code:text<currencyisocode
created_date:time<createddate last_activity_date:time<lastactivitydate
last_modified_date:time<lastmodifieddate last_referenced_date:time<lastreferenceddate
last_viewed_date:time<lastvieweddate system_mod_stamp:time<systemmodstamp
"""

LEGACY_REGISTRATION = """
deal_registration_id channel_account_manager_id created_by_id current_user_id distributor_account_id
distributor_rep_id {org}_contact_id last_modified_by_id lead_id opportunity_id owner_id partner_account_id
partner_sales_rep_id preferred_distributor_id rd_manager_for_approvals_id x18_digit_deal_registration_id
x18_digit_owner_id add_teaming_partner am_approved am_rejected eligible_for_resubmission is_clone is_deleted
is_resubmitted is_there_a_budget_defined partner_agrees_to_set_up_meeting
partner_met_or_spoken_with_a_customer reprocess_notifications_distributor
registration_status<teaming_request_status deal_registration_type denial_reason<decline_reason
partner_account_name distributor_account_name distributor_rep_name {org}_contact_name opportunity_owner_name
opportunity_owner_rd_name partner_sales_rep_name atgexternal_id business_justification_for_decline
champion_business_title champion_contact_email champion_contact_first_name champion_contact_last_name
champion_contact_phone company currency_iso_code days_since_approval deal_reg_comments
deal_registration_extension_approval deal_registration_name dealreg_extension_partner_justification
denied_party_screening_status lead_owner_email {org}_contact_mailto partner_support_comments
products_of_interest project_driver reseller_company_name reseller_sales_rep_name resubmission_comments
value_adds approved_date created_date expected_close_date expiration_date last_activity_date
last_modified_date last_referenced_date last_viewed_date system_mod_stamp edp_updated_at
"""

PORTAL_REGISTRATION = """
vartopia_registration_id am_vartopia_record_id child_registration_id created_by_id customer_account_id
customer_account_owner_id customer_contact_id distributor_account_id distributor_contact_id lead_id
mdf_campaign_id opportunity_id opportunity_owner_id partner_account_id partner_manager_2_id
primary_registration_id prospect_contact_id sales_rep_id vartopia_sf_registration_id vendor_approval_id
migrated_to_vartopia is_native_vartopia_registration is_approved_by_vartopia is_clone is_created_by_auto_reg
is_created_from_mvs is_created_from_registration is_ez_update_eligible is_registration_extended
is_registration_sent_to_vartopia is_send_update_request is_sent_to_vartopia is_sync_with_vartopia
registration_status<vendor_status deal_registration_type<true_source partner_account_name
distributor_account_name opportunity_owner_name active_customer_registrations am_campaign_id
am_incentive_amount am_incentive_type am_program_name am_vendor_unique_id approved_regs_count
approved_regs_partner_rep_count business_justification closed_won_partner_rep_count closed_won_regs_count
comments contact_geo customer_address_line2 customer_name days_since_approval days_to_approve days_to_denied
days_to_progress deal_name deal_registration_name default_account_source default_account_type
default_opp_stage denial_reason error_message extension_status internal_notes lead_source legacy_dr_id
no_of_attempts opportunity_amount opportunity_stage_name partner_notes partner_status program_name
reg_days_since_submitted registration_lot_number registration_url request_sent_count solution_name
submitter_type updates_received_from_partner approved_date created_date current_date_time expected_close_date
expiration_date last_modified_date last_referenced_date last_request_for_update
last_update_provided_by_partner last_updated_for_vartopia last_viewed_date next_update_auto_request_date
reg_auto_sync_time reg_denied_date time_to_approve is_deleted edp_updated_at
"""

UNIFIED_REGISTRATION = """
source_system registration_id migrated_to_vartopia is_native_vartopia_registration created_by_id
distributor_account_id opportunity_id opportunity_owner_id partner_account_id partner_sales_rep_id
distributor_account_name opportunity_owner_name partner_account_name is_clone is_deleted add_teaming_partner
eligible_for_resubmission is_resubmitted approved_date created_date days_since_approval deal_registration_name
denial_reason expected_close_date expiration_date last_modified_date deal_registration_type
registration_status company deal_reg_comments partner_support_comments products_of_interest comments
customer_name deal_name internal_notes is_registration_extended last_updated_for_vartopia reg_denied_date
edp_updated_at
"""

USER = """
user_id assigned_territory company_name created_by_id created_date department direct_manager_name
direct_manager_title email first_name geo has_manager_flag has_vp_sales_flag is_active {employee}
is_manager_flag last_name login_username manager_chain_depth manager_id manager_level_1_name
manager_level_1_title manager_level_1_user_id manager_level_2_name manager_level_2_title
manager_level_2_user_id manager_level_3_name manager_level_3_title manager_level_3_user_id
manager_level_4_name manager_level_4_title manager_level_4_user_id manager_level_5_name manager_level_5_title
manager_level_5_user_id manager_level_6_name manager_level_6_title manager_level_6_user_id
manager_level_7_name manager_level_7_title manager_level_7_user_id profile_id profile_name region
role_start_date title top_manager_name top_manager_title user_name user_role_id user_role_name user_type
vp_sales_id vp_sales_name vp_sales_title last_modified_date system_modstamp edp_updated_at
"""

OPPORTUNITY = """
opportunity_id account_id ae_acceptance_status age amended_contract bdr_created_opportunity
blox_one_ps_provider bva_support_task_count campaign_id close_date close_date_change_count close_date_prior
close_date_push_count cloud_marketplace co_sell_registered contact created_date created_by_id daybreak_status
deal_reg_type deal_term_month<deal_term_in_months decommission_reason discovery_notes
distributor_id<distributor2 dl_vc_has_value_proposition drop_down_status_of_arch_workbook_sa_ow
ela_flag<is_ela expiration_date has_bva_task_without_bva_record health_check hold_reasons
is_there_a_defined_budget is_there_a_specific_need in_flight_legal_negotiations
last_modified_by_opportunity_owner last_stage_change_date_standard<last_stage_change_date_c lead_source
level_of_authority marketplace_transaction_type next_step next_steps non_qualified_loss_flag
opportunity_deal_source opportunity_desc<description closed_lost_exclusion_flag
revops_reporting_exclusion_flag opportunity_incumbent opportunity_name<name opportunity_owner_country
opportunity_owner_geo opportunity_owner_id<owner_id opportunity_owner_name opportunity_owner_region
opportunity_record_type<record_type_id opportunity_record_type_desc opportunity_sales_motion<expansion
stage_group opportunity_stage<stage_name stage_order opportunity_type<type order_type
order_type_desc<om_order_type other_primary_competitor owner_territory owner_territory_id<territory_id
partner_account_name po_mismatch primary_competitor primary_quote_deal_reg<teaming_hunting
project_driver<compelling_project_driver ps_source_opportunity<opportunity_source purchase_timeframe
qualified_date renewal_at_risk renewal_forecast resolved_synced_quote_id resolved_quote_source_system
reseller_id reseller_level reseller_partner_classification reseller_partner_segmentation risk_validation
sal_date sales_forecast_category sales_forecast_category_bridge sbqq_amended_contract
secondary_win_loss_reason sp_products<saas_products sql_date stage_prior_to_close technical_win
vartopia_primary_id why_change {why_us} why_now win_loss_reason win_loss_reason_desc<win_loss_comments
opportunity_scd_id last_modified_date edp_valid_from edp_valid_to edp_updated_at is_current is_deleted
"""

PRODUCT = """
product2_id base_sku bloxone_tier card_connectivity created_by_id created_date currency_iso_code
deferred_commission_cogs_account deferred_material_cogs_account deferred_payroll_and_other_cogs_account
deferred_product_cogs_account deferred_revenue_account deferred_royalty_cogs_account description
discount_category dossier_included end_customer_type eol eosl evaluation_eligible
exclude_from_maintenance_calculation family finance_product_category from_gsw generate_asset gs_hw_sw_size
hw_sw_family hw_sw_size in_csp ip_count is_active is_assetizable is_legacy last_modified_by_id
lic_ddi_license_features lic_device_limit lic_dhcp_limit lic_grid_wide lic_host_type lic_hwul_limit
lic_license_technology lic_load_bal_limit lic_netmri_license_features lic_nios_limit lic_pool_lpc_eligible
lic_sam_limit lic_target_host_type lic_vnios_limit lpm maintenance_provider maintenance_service_level
marketplace_eligible mlta_dca_tier mlta_load_bal_limit mlta_number_of_dossier_queries mlta_oc
mlta_reporting_limit mlta_reporting_sub_limit mlta_saas_number_of_devices mlta_saas_number_of_users
mlta_sec_eco_limit mlta_spm_license_limit msp_spla_approved name percent_renewal_uplift
perpetual_or_subscription physical_or_virtual power_supply_unit product_category product_class product_code
product_generation product_group product_id_18 product_line product_sub_type product_sub_type_ii product_type
quantity_unit_of_measure real_standalone_availability recognized_material_cogs_account renewal_uplift_eligible
revenue_product_category royalty_amount_per_unit royalty_cogs_account royalty_of_extended_price
royalty_vendor_name saas_number_of_dossier_queries saas_service_level sales_account_id sbqq_billing_frequency
sbqq_block_pricing_field sbqq_component sbqq_custom_configuration_required sbqq_default_quantity
sbqq_exclude_from_maintenance sbqq_exclude_from_opportunity sbqq_externally_configurable
sbqq_has_configuration_attributes sbqq_hidden sbqq_hide_price_in_search_results sbqq_include_in_maintenance
sbqq_non_discountable sbqq_non_partner_discountable sbqq_optional sbqq_price_editable sbqq_pricing_method
sbqq_pricing_method_editable sbqq_quantity_editable sbqq_reconfiguration_disabled sbqq_subscription_category
sbqq_subscription_percent subscription_pricing_model<sbqq_subscription_pricing sbqq_subscription_term
sbqq_subscription_type sbqq_taxable scoping_category shipment_schedule_required single_partner_sku
software_entitlement standalone_availability threat_insight_included tokens_in_pack token_based_sku
training_ratable utilize_install_base_pricing value_derived_from_sow acv_eligible_flag
nacv_pricing_eligible_flag product_selling_model_name product_group_name saas_prod_group_old saas_prod_group
blox_one_product_group subscription_type_desc revenue_category finance_product_category_rollup
finance_product_category_summary product_group_new model_logic_version product_sk last_modified_date
system_modstamp is_deleted
"""

QUOTE_DIMENSION = """
quote_unified_sk source_system quote_id account_id created_by_id distributor_id last_modified_by_id
legacy_quote_id opportunity_id owner_id partner_account_id pricebook2_id price_book_id record_type_id
record_type_name reseller_id sales_rep_id ship_to_contact_id ship_to_id submitted_user_id approval_status
co_term_end_date created_date discount_justification end_date expiration_date is_migrated_quote
is_refresh_quote is_syncing line_item_count opportunity_close_date primary_deal_reg_type promotion
quote_line_count quote_name quote_number quote_status quote_type refresh_quote_flag start_date
subscription_term submitted_date system_modstamp is_deleted
"""

QUOTE_FACT = """
quote_unified_sk source_system quote_id approval_status co_term_end_date created_date end_date expiration_date
is_deleted is_migrated_quote is_refresh_quote is_syncing primary_deal_reg_type quote_name quote_number
quote_status quote_type refresh_quote_flag start_date submitted_date has_refresh_quote_line acv acv_downsell
acv_override_gross_renewal_acv b1ddi_net_renewal_acv b1ddi_new_business_acv b1td_net_renewal_acv
b1td_net_renewal_acv_override b1td_new_business_acv converted_perp_sw_acv converted_term_sw_acv
crosssell_upsell_acv downsell_acv existing_business_renewed_acv expansion_acv expiring_acv
expiring_acv_being_renewed expiring_acv_to_be_renewed expiring_n_acv gross_refresh_acv gross_renewal_acv
gross_renewal_acv_historical new_business_acv prorated_expiring_acv raw_expiring_acv refresh_acv
refresh_retiring_acv renewal_acv renewal_forecast saas_acv saas_net_renewal_acv saas_new_business_acv tcv
true_expansion_acv uplift_acv uplift_override
"""

# Raw user columns read by the user dimension.
RAW_USER = """
user_id territory company_name created_by_id created_date department email first_name geo region is_active
last_modified_date last_name manager_id profile_id role_start_date system_modstamp title name user_role_id
user_type username vp_sales is_current
"""

# Where the two quote systems' headers differ from the shared names: published name -> raw column.
RCA_QUOTE_NAMES = {
    "distributor_id": "distributor",
    "price_book_id": "price_book",
    "reseller_id": "reseller",
    "sales_rep_id": "sales_rep",
    "ship_to_contact_id": "ship_to_contact",
    "submitted_user_id": "submitted_user",
    "primary_deal_reg_type": "deal_reg_type",
    "quote_name": "quote_number",
    "quote_status": "status",
    "quote_type": "type",
    "new_business_acv": "acv_delta",
}
CPQ_QUOTE_NAMES = {
    "quote_id": "sbqq_quote_id",
    "account_id": "sbqq_account",
    "distributor_id": "sbqq_distributor",
    "opportunity_id": "sbqq_opportunity2",
    "pricebook2_id": "sbqq_pricebook_id",
    "price_book_id": "sbqq_price_book",
    "reseller_id": "reseller",
    "sales_rep_id": "sbqq_sales_rep",
    "ship_to_id": "ship_to",
    "submitted_user_id": "submitted_user",
    "end_date": "sbqq_end_date",
    "expiration_date": "sbqq_expiration_date",
    "is_syncing": "sbqq_primary",
    "line_item_count": "sbqq_line_item_count",
    "quote_line_count": "sbqq_line_item_count",
    "primary_deal_reg_type": "deal_reg_type",
    "quote_number": "name",
    "quote_status": "sbqq_status",
    "quote_type": "sbqq_type",
    "refresh_quote_flag": "refresh_quote",
    "start_date": "sbqq_start_date",
    "subscription_term": "sbqq_subscription_term",
    "existing_business_renewed_acv": "renewal_acv",
    "gross_renewal_acv_historical": "expiring_acv",
    "saas_new_business_acv": "saas_ddi_new_business_acv",
    "crosssell_upsell_acv": "expansion_acv",
    "gross_refresh_acv": "refresh_acv",
    "new_business_acv": "acv_delta",
    "uplift_acv": "uplift2_acv",
}
# Header columns and measures the second system does not have.
CPQ_MISSING = ("legacy_quote_id", "partner_account_id", "ship_to_contact_id", "co_term_end_date")
CPQ_ZERO_MEASURES = ("expiring_acv_being_renewed", "saas_acv", "saas_net_renewal_acv")
# Columns the quote models compute themselves.
QUOTE_COMPUTED = (
    "quote_unified_sk",
    "source_system",
    "record_type_name",
    "is_migrated_quote",
    "is_refresh_quote",
    "refresh_quote_flag",
    "quote_line_count",
    "has_refresh_quote_line",
)

# Types of published columns, the same in every table; other columns keep the type they come with.
TYPES = {
    "boolean": """
acv_eligible_flag add_teaming_partner am_approved am_rejected closed_lost_exclusion_flag eligible_for_resubmission
{employee} has_bva_task_without_bva_record has_manager_flag has_refresh_quote_line has_vp_sales_flag is_active
is_approved_by_vartopia is_clone is_created_by_auto_reg is_created_from_mvs is_created_from_registration is_current
is_deleted is_ez_update_eligible is_manager_flag is_migrated_quote is_native_vartopia_registration is_refresh_quote
is_registration_extended is_registration_sent_to_vartopia is_resubmitted is_send_update_request is_sent_to_vartopia
is_sync_with_vartopia migrated_to_vartopia nacv_pricing_eligible_flag non_qualified_loss_flag
partner_agrees_to_set_up_meeting partner_met_or_spoken_with_a_customer refresh_quote_flag
reprocess_notifications_distributor revops_reporting_exclusion_flag
""",
    "timestamp": """
approved_date close_date_prior created_date current_date_time edp_updated_at expected_close_date expiration_date
last_modified_date last_referenced_date last_request_for_update last_update_provided_by_partner
last_updated_for_vartopia last_viewed_date next_update_auto_request_date reg_auto_sync_time reg_denied_date
system_modstamp system_mod_stamp time_to_approve
""",
    "bigint": "bva_support_task_count close_date_change_count close_date_push_count quote_line_count",
    "int": "manager_chain_depth stage_order",
    "string": """
product_sk quote_unified_sk source_system user_name registration_status deal_registration_type denial_reason
partner_account_name distributor_account_name opportunity_owner_name stage_group saas_prod_group_old saas_prod_group
""",
}
# Columns whose names end so hold ids.
ID_ENDING = "_id"

# ---------------------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------------------


def _bare(name: str) -> str:
    return name.removesuffix("_id")


def _portal_source(name: str, kind: str) -> str:
    bare = _bare(name)
    return f"vartopiadrs__{bare.removeprefix('is_') if kind == 'flag' else bare}__c"


def legacy_staging(cfg: Config) -> list[Field]:
    return parse_fields(cfg.spell(LEGACY_STAGING), lambda name, kind: f"{_bare(name)}__c")


def portal_staging(cfg: Config) -> list[Field]:
    return parse_fields(cfg.spell(PORTAL_STAGING), _portal_source)


def published_types(columns: list[str], cfg: Config) -> dict[str, str]:
    """The declared types among some published columns."""
    declared = {name: kind for kind, names in TYPES.items() for name in cfg.spell(names).split()}
    return {c: declared.get(c, "string") for c in columns if c in declared or c.endswith(ID_ENDING)}


def published(contract: str, cfg: Config) -> list[Field]:
    """The published columns of a model: name and, where it differs, the column it renames."""
    return parse_fields(cfg.spell(contract))
