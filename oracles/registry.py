"""All oracles by query key."""

from oracles import ads, attribution, clients, crm, events, sales, stock


def oracle_sql() -> dict[str, str]:
    result: dict[str, str] = {}
    for module in (sales, ads, stock, crm, clients, attribution, events):
        result.update(module.oracles())
    return result
