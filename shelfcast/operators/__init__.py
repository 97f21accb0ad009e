"""DataFrame operators: views, features, hierarchy, quality, exploration, insights."""
