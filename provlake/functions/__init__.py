"""provlake.functions"""
