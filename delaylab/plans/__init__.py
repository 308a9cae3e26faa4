"""Named queries over the driver tables (the driver contract) and plan inspection."""
