"""SQL scopes, transforms, and the registered queries."""
