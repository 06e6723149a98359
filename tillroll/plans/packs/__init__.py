"""The built-in rules, one module per kind of provider."""

from tillroll.plans.packs import banks, shops, wallets

BUILT_IN = (*banks.RULES, *wallets.RULES, *shops.RULES)
