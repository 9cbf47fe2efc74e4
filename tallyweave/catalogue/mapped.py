"""Mappings of raw entities to canonical tables."""

from __future__ import annotations

from tallyweave.catalogue.adapters import AS_OF, MAPPED, raw
from tallyweave.catalogue.registry import query
from tallyweave.operators import mapping


@query("map_billing_customers", MAPPED["billing_customers"])
def map_billing_customers(spark, folder):
    return mapping.billing_customers(raw(spark, folder, "billing_customers"), AS_OF)


@query("map_charges", MAPPED["billing_charges"])
def map_charges(spark, folder):
    return mapping.billing_charges(raw(spark, folder, "billing_charges"), AS_OF)


@query("map_subscriptions", MAPPED["billing_subscriptions"])
def map_subscriptions(spark, folder):
    return mapping.billing_subscriptions(raw(spark, folder, "billing_subscriptions"), AS_OF)


@query("map_companies", MAPPED["crm_companies"])
def map_companies(spark, folder):
    return mapping.crm_companies(raw(spark, folder, "crm_accounts"), AS_OF)


@query("map_account_customers", MAPPED["crm_account_customers"])
def map_account_customers(spark, folder):
    return mapping.crm_account_customers(raw(spark, folder, "crm_accounts"), AS_OF)


@query("map_contacts", MAPPED["crm_contacts"])
def map_contacts(spark, folder):
    return mapping.crm_contacts(raw(spark, folder, "crm_contacts"), AS_OF)


@query("map_opportunities", MAPPED["crm_opportunities"])
def map_opportunities(spark, folder):
    return mapping.crm_opportunities(raw(spark, folder, "crm_opportunities"), AS_OF)


@query("map_orders", MAPPED["crm_orders"])
def map_orders(spark, folder):
    return mapping.crm_orders(raw(spark, folder, "crm_orders"), AS_OF)
