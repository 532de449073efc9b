"""Fixtures and registered queries with their SQL oracles."""

from earshot.plans import registry as registry  # the registry loads the query modules in their order
