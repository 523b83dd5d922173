"""granary.sources"""
