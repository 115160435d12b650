"""All registered queries; importing the groups fills the registry."""

from entityloom.catalog import community, entities, outputs, values, webpages  # noqa: F401
from entityloom.catalog.registry import CATALOG  # noqa: F401
