"""Where data comes from: notifications, the registry, feature files."""
